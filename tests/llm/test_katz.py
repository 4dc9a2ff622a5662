import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimloom.llm import katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Plain:
    """The same model by dictionaries."""

    def __init__(self, documents):
        self.uni, self.bi = Counter(), Counter()
        for words in documents:
            tokens = [*words, "</s>"]
            self.uni.update(tokens)
            self.bi.update(zip(["<s>", *tokens], tokens))
        of = lambda c: [sum(v == r for v in c.values()) for r in range(1, katz.GOOD_TURING + 2)]
        self.tokens = sum(self.uni.values())
        self.kept, self.pair_kept = katz.discounts(of(self.uni)), katz.discounts(of(self.bi))
        lost = sum((1 - self.keep(self.kept, c)) * c for c in self.uni.values())
        self.total = self.tokens if lost > 0 else self.tokens + 1
        self.unknown = 1 - sum(self.keep(self.kept, c) * c for c in self.uni.values()) / self.total
        self.after = defaultdict(dict)
        for (h, w), c in self.bi.items():
            self.after[h][w] = c

    @staticmethod
    def keep(kept, count):
        return kept[count] if count <= katz.GOOD_TURING else 1.0

    def low(self, w):
        return self.keep(self.kept, self.uni[w]) * self.uni[w] / self.total if w in self.uni else self.unknown

    def chance(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.low(w)
        total = sum(seen.values())
        lost = sum((1 - self.keep(self.pair_kept, c)) * c for c in seen.values())
        total, lost = (total, lost) if lost > 0 else (total + 1, 1)
        if w in seen:
            return self.keep(self.pair_kept, seen[w]) * seen[w] / total
        return lost / total / (1 - sum(map(self.low, seen))) * self.low(w)


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = [f"w{int(rng.expovariate(0.05))}" for _ in range(400)] + ["É", "The"]
    found = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    return found + [None, "", " \n", "unheard of words", found[0].upper(), "the " * 3000, found[3], found[3]] + [
        f"{vocabulary[i]} new{i} {vocabulary[i + 1]} new{i}" for i in range(60)
    ]


@pytest.mark.parametrize(("batch", "hot"), [(10**6, 90), (40, 90), (40, 1), (10**6, 10**6)])
def test_scores_against_dictionaries(docs, texts, batch, hot, monkeypatch):
    monkeypatch.setattr(katz, "LEAST_BUCKETS", 4)
    monkeypatch.setattr(katz, "HOT_TOKENS", hot)
    table = docs(texts).selectExpr("*", "'x' AS batch", "1 AS train").repartition(3 if batch > 40 else 60)
    found = katz.score_documents(table).collect()
    assert len(found) == len(texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    plain = Plain([words_of(t) for i, t in enumerate(texts) if not held(i)])
    for r in found:
        tokens = [*words_of(texts[r.doc_id]), "</s>"]
        assert r.held_out == held(r.doc_id)
        assert (r.n_tokens, r.train_tokens) == (len(tokens), plain.tokens)
        assert r.n_known == sum(t in plain.uni for t in tokens)
        base = sum(math.log10((plain.uni[t] + 1) / (plain.tokens + len(plain.uni) + 1)) for t in tokens)
        score = sum(math.log10(plain.chance(h, w)) for h, w in zip(["<s>", *tokens], tokens))
        assert abs(r.base_score - base) < 1e-6 * len(tokens)
        assert abs(r.score - score) < 1e-6 * len(tokens)


def test_every_context_adds_up_to_one(texts):
    plain = Plain([words_of(t) for t in texts])
    for h in ["<s>", *list(plain.uni)[:40]]:
        assert abs(sum(plain.chance(h, w) for w in plain.uni) + plain.chance(h, "?") - 1) < 1e-9


def test_discounts():
    fine = katz.discounts([600, 200, 90, 50, 30, 20])
    assert fine[0] == 1 and (0 < fine[1:]).all() and (fine[1:] < 1).all()
    assert katz.discounts([0] * 6).tolist() == [1.0, 0.5, 0.75, 1 - 0.5 / 3, 0.875, 0.9]


def test_packing():
    for values in (np.array([], np.uint64), np.array([1, 2**63], np.uint64), np.array([1.5, -2.0]), np.arange(5, dtype=np.uint32)):
        again = katz.unpack(katz.pack(values))
        assert again.dtype == values.dtype and again.tolist() == values.tolist()


def test_nothing_to_learn(spark, docs):
    assert katz.score_documents(docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    table = spark.createDataFrame([(held, "a b"), (held, None)], "doc_id bigint, text string")
    assert [(r.n_known, r.train_tokens, r.score, r.base_score) for r in katz.score_documents(table).collect()] == [(0, 0, 0, 0)] * 2
    one = spark.createDataFrame([(None, "a b a"), (None, "a b a")], "doc_id bigint, text string")
    rows = katz.score_documents(one).collect()
    assert len(rows) == 2 and rows[0].train_tokens == 8 and rows[0].score < 0


def test_pairs_of_a_hot_context_and_of_a_frequent_word_are_spread():
    contexts, words = np.arange(4096, dtype=np.uint64) << np.uint64(32), np.full(4096, 5)
    assert np.bincount(katz._spread(contexts, words, 8), minlength=256).max() < 64
    assert np.bincount(katz._spread(contexts[:1].repeat(256), np.arange(256), 8), minlength=256).tolist() == [1] * 256
