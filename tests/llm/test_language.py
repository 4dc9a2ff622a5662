import itertools
import random
import zlib

import numpy as np
import pytest

from claimloom.llm import language_spans


def brute_best(scores, penalty):
    n, k = scores.shape
    value = lambda path: sum(scores[i, p] for i, p in enumerate(path)) - penalty * sum(
        a != b for a, b in zip(path, path[1:])
    )
    return max(value(path) for path in itertools.product(range(k), repeat=n)), value


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    for penalty in (0.1, 1.0, 3.0):
        for _ in range(60):
            scores = rng.normal(size=(rng.integers(1, 7), 3))
            best, value = brute_best(scores, penalty)
            assert abs(value(language_spans.viterbi(scores, penalty).tolist()) - best) < 1e-9


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(1)
    syllables = {"xa": ["lo", "mi", "ra"], "yb": ["ke", "zu", "wox"], "zg": ["αλ", "μο", "ρε"]}
    make = lambda lang, n: " ".join(
        "".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)
    )
    rows = [(i, make(lang := list(syllables)[i % 3], 5 + i % 40), lang, "s") for i in range(300)]
    return make, rows


def test_held_out_accuracy_and_cases(spark, sample):
    make, rows = sample
    mixed = make("xa", 60) + " " + make("yb", 30)
    odd = [None, "", "12 !! \n", mixed, make("zg", 40) + " " + make("xa", 10), "東京" * 5, make("xa", 40_000)]
    rows = rows + [(1000 + i, t, None, "s") for i, t in enumerate(odd)] + [(None, "lomi", "xa", None)] + rows[:1]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    docs = docs.selectExpr("*", "1.0 AS score", "'q' AS held_out")
    found = language_spans.identify(docs).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    for r in found:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(key.encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    own = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in own]) > 0.97
    odd_found = {r.doc_id - 1000: r for r in found if r.doc_id is not None and r.doc_id >= 1000}
    assert [odd_found[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3
    assert (odd_found[3].lang_pred, odd_found[4].lang_pred, odd_found[6].lang_pred) == ("xa", "zg", "xa")
    assert odd_found[3].score < 0.9
    kept = language_spans.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()}.isdisjoint({1000, 1001, 1002})
    assert kept.filter("doc_id < 1000").count() == 301


def test_spans_of_a_mixed_text(spark, sample):
    make, rows = sample
    model = language_spans.fit(spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string"))
    spans = model.spans(make("xa", 30) + " " + make("zg", 20) + " " + make("yb", 25))
    assert [s[2] for s in spans] == ["xa", "zg", "yb"]
    assert abs(spans[0][1] - 30) <= 1 and abs(spans[1][1] - 50) <= 1


def test_nothing_learned(docs):
    empty = docs([])
    assert language_spans.identify(empty).count() == 0
    model = language_spans.fit(empty.select("doc_id", "text", "lang"))
    assert model.predict("some text") == ("und", 0.0)


def small_model(seed=3):
    """Three languages with made-up scores: two write latin, one cyrillic and han."""
    rng = np.random.default_rng(seed)
    writes = np.zeros((len(language_spans._SCRIPTS), 3), bool)
    writes[language_spans._SCRIPTS.index("latin"), :2] = True
    for name in ("cyrillic", "han"):
        writes[language_spans._SCRIPTS.index(name), 2] = True
    return language_spans.Model(["aa", "bb", "cc"], rng.normal(size=(language_spans.CELLS, 3)).astype(np.float32), writes)


MIXED = ["xПривет", "東京タワー", "ab1cd", "éa bПb", "a" * 200 + "Ж" * 90 + " z", "", "12", "ab " * 60 + "пр " * 50]


def plain_words(text):
    """(word, script), a letter at a time."""
    script = lambda c: max((start, name) for start, name in language_spans.SCRIPT_STARTS if start <= ord(c))[1]
    words = []
    last = None
    for c in text.lower():
        kind = script(c) if c.isalpha() else None
        if kind is not None:
            if kind == last:
                words[-1][0] += c
            else:
                words.append([c, kind])
        last = kind
    return words


def plain_scores(model, text):
    """Letters and scores of each word, a trigram at a time."""
    sizes, rows = [], []
    for word, script in plain_words(text):
        framed = [0, *map(ord, word), 0]
        total = np.zeros(3)
        for x, y, z in zip(framed, framed[1:], framed[2:]):
            cell = ((x * 0x9E3779B1 + y) * 0x85EBCA77 + z) % 2**64
            total += model.cells[(cell * 0x9E3779B97F4A7C15 % 2**64) >> 48]
        may = model.writes[language_spans._SCRIPTS.index(script)]
        if may.any():
            total = np.where(may, total, total.min() - language_spans.RULED_OUT)
        sizes.append(len(word))
        rows.append(total)
    return sizes, rows


def plain_predict(model, text, penalty):
    """The usual walk, a word and a language at a time."""
    sizes, rows = plain_scores(model, text)
    if not sizes:
        return "und", 0.0
    best = [(rows[0][j], [j]) for j in range(3)]
    for row in rows[1:]:
        came = [max(range(3), key=lambda i: best[i][0] - penalty * (i != j)) for j in range(3)]  # noqa: B023
        best = [(best[i][0] - penalty * (i != j) + row[j], best[i][1] + [j]) for j, i in enumerate(came)]
    path = max(best, key=lambda b: b[0])[1]
    letters = np.bincount(path, sizes, 3)
    return model.languages[int(letters.argmax())], letters.max() / letters.sum()


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 1 << 18])
def test_words_end_where_the_script_changes_and_nowhere_else(monkeypatch, chunk):
    monkeypatch.setattr(language_spans, "_CHUNK", chunk)
    assert [tuple(w) for w in plain_words("xПривет")] == [("x", "latin"), ("привет", "cyrillic")]
    assert [w[1] for w in plain_words("東京タワー")] == ["han", "kana"]
    model = small_model()
    for text in MIXED:
        sizes, scores = model.scores(text)
        plain_sizes, plain = plain_scores(model, text)
        assert sizes.tolist() == plain_sizes
        if plain:
            assert np.allclose(scores, plain, atol=1e-3)


def test_predictions_against_a_plain_walk(monkeypatch):
    rng = random.Random(8)
    pieces = ["ab", "cda", "Пр", "ивет", "東京", "タ", " ", " ", ", ", "x", "é"]
    texts = MIXED + ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    model = small_model()
    for penalty in (0.5, 4.0, 12.0):
        found = list(model.predict_all(texts, penalty))
        for text, (lang, score) in zip(texts, found, strict=True):
            assert (lang, pytest.approx(score)) == plain_predict(model, text, penalty)
        monkeypatch.setattr(language_spans, "WALK_TEXTS", 7)
        monkeypatch.setattr(language_spans, "WALK_SCORES", 200)
        assert list(model.predict_all(texts, penalty)) == found
        monkeypatch.undo()


def test_a_word_longer_than_several_chunks_is_one():
    long = "ab" * (3 << 18)
    assert small_model().scores("x " + long + " y")[0].tolist() == [1, len(long), 1]
