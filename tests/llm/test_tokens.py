import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimloom.llm import bpe_tree, token_counts, token_store

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def shuffled_texts():
    rng = random.Random(5)
    bits = ["a", "bc", " ", "  ", "\n", "'s", "'", "'r", "e", "é", "\xa0", "　", "12", "!", "▁", "東", "\t", "\x1c", "\x85"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(400))) for _ in range(300)]


def test_tree_equals_the_library(ranks, odd_texts):
    for text in [t for t in odd_texts if t is not None] + shuffled_texts():
        expected = ranks.encode_ordinary(text)
        for leaf in (7, 64, 8192):
            if leaf < 64 and len(text) > 5000:
                continue
            ids = bpe_tree.encode(ranks, text, leaf)
            assert ids.tolist() == expected
            assert bpe_tree.decode(ranks, ids, 5 if leaf == 7 else 16384) == text.encode()


def test_encode_documents_round_trip(docs, ranks, odd_texts):
    table = docs(odd_texts)
    encoded = bpe_tree.encode_documents(table, RANKS, public_tokenizers.PATTERN)
    found = {r.doc_id: r.ids for r in encoded.collect()}
    for i, text in enumerate(odd_texts):
        assert np.frombuffer(found[i], "<u4").tolist() == ranks.encode_ordinary(text or "")
    decoded = {r.doc_id: r.text for r in bpe_tree.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()}
    assert decoded == {i: bytearray((t or "").encode()) for i, t in enumerate(odd_texts)}
    digests = bpe_tree.digest_documents(table, RANKS, public_tokenizers.PATTERN).collect()
    for r in digests:
        text = (odd_texts[r.doc_id] or "").encode()
        assert r.ids_sha256 == hashlib.sha256(found[r.doc_id]).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text).hexdigest()
    assert bpe_tree.digest_documents(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_counts_equal_the_library(docs, odd_texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.Counter(PIECES)
    assert counter.proves_cuts
    for text in [t for t in odd_texts if t is not None and len(t) < 45_000] + shuffled_texts():
        for chunk, overlap in ((16, 2), (300, 8), (16384, 256)):
            if chunk == 16 and len(text) > 3000:
                continue
            assert counter.count(text.encode(), chunk, overlap) == len(model.encode(text)), (text[:50], chunk)
    rows = token_counts.count_tokens(docs(odd_texts), PIECES).collect()
    for r in rows:
        text = odd_texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(model.encode(text)))
        assert r.over_limit == (r.n_tokens > 4096)
    assert token_counts.count_tokens(docs([]), PIECES).count() == 0


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def test_words_encode_as_the_whole_text(words, odd_texts):
    encoder = token_store.WordEncoder(WORDS, kept=50)
    texts = [t for t in odd_texts if t is not None] + shuffled_texts() + ["\x01 a \x01b Å Å ́x"]
    for text in texts:
        ids = np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist()
        assert ids == words.encode(text, add_special_tokens=False).ids, text[:80]


def test_latin_words_do_not_need_the_whole_library(words):
    rng = np.random.default_rng(5)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    latin_letters = [c for c in map(chr, [*range(0x61, 0x7B), *range(0xDF, 0x180)]) if c.islower()]
    latin = ["".join(rng.choice(latin_letters, n)) for n in rng.integers(1, 12, 400)]
    texts = ["".join(f"{a}{m}{b}{m}{m} " for m, a, b in zip(marks * 10, latin, reversed(latin))), *latin]
    encoder = token_store.WordEncoder(WORDS)
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == words.encode(text, add_special_tokens=False).ids, text[:80]
    encoder.encode(["a***".encode()])
    encoder._library = None
    assert encoder.encode(["déjà mot*** œuvre łódź".encode()])[0]


def test_codes_give_any_token():
    rng = np.random.default_rng(3)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1], rng.integers(0, 70_000, 5000).tolist()):
        codes = token_store.Codes.build(np.array(ids, np.uint32))
        again = token_store.Codes.read(codes.tobytes())
        assert again.slice(0, len(ids)).tolist() == ids
        for i in rng.integers(0, max(1, len(ids)), 50).tolist() if ids else []:
            assert again[i] == ids[i]
        assert again.slice(3, 7).tolist() == ids[3:7]


def test_store_keeps_order_and_starts(spark, docs, words, odd_texts):
    texts = odd_texts + ["two", "two"]
    table = docs(texts).repartition(5)
    store = token_store.write(table, WORDS, 2, partitions=3, segment_ids=1000)
    rows = sorted(token_store.documents(store).collect())
    start = 0
    for r, text in zip(rows, texts, strict=True):
        ids = [*words.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    everything = [i for t in texts for i in [*words.encode(t or "", add_special_tokens=False).ids, 2]]
    places = [0, 1, start // 2, start - 1]
    asked = spark.createDataFrame([(p,) for p in places], "position bigint")
    found = {r.position: r.token for r in token_store.tokens_at(store, asked).collect()}
    assert found == {p: everything[p] for p in places}
    empty = token_store.write(docs([]), WORDS, 2, partitions=3)
    assert token_store.documents(empty).count() == 0


def test_repeated_and_missing_ids(spark, words):
    rows = [(None, "a"), (5, "b"), (5, "b"), (5, "c"), (1, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = token_store.documents(token_store.write(table, WORDS, 2)).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in found) == [(-1, 2), (1, 1), (5, 2), (5, 2), (5, 2)]
    assert sorted(r.start for r in found) == [0, 2, 3, 5, 7]
