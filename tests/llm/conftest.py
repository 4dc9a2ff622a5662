import base64

import public_tokenizers
import pytest
import tiktoken


@pytest.fixture(scope="session")
def odd_texts():
    """Whole-text cases every per-document operator must take."""
    words = "the quick brown fox's été jumps 12 over naïve 東京 dogs!  ok\t\n"
    return [
        None,
        "",
        " ",
        "\n\n \t",
        "a",
        words * 800,
        "x" * 40_000,
        " " * 30_000 + "y",
        "don't 're  '" * 3000,
        "東京" * 12_000,
        "a　b\xa0c " * 5000,
        "<|endoftext|> <s> </s> <unk> ▁ a ▁b" * 900,
        "é" * 20_000 + " " + "z " * 9000,
        words * 800,
    ]


@pytest.fixture(scope="session")
def docs(spark):
    def make(texts, **extra):
        rows = [(i, t, "en", "src", 0) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return make


@pytest.fixture(scope="session")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})
