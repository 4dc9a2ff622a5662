import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import hard_negatives
from claimloom.llm.hard_negatives import PRIMES, Residues, best_first

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    """The same by whole numbers of Python; (id, label, vector, place) of the rows that take part."""
    kept = []
    for k, (i, vec, label) in enumerate(rows):
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        kept.append((i, label, [math.floor(256 * float(np.float32(x))) for x in vec], k))
    found = []
    for i, label, vec, k in kept:
        if i is None or i % 100:
            continue
        others = [(-sum(a * b for a, b in zip(vec, v)), j is None, j or 0, j, m, own) for j, own, v, m in kept if m != k]
        others.sort(key=lambda o: o[:3])
        for score, _, _, j, _, _ in [o for o in others if o[5] == label][:5]:
            fits = [o for o in others if o[5] != label and 30 * -score <= 100 * -o[0] <= 90 * -score]
            found += [(i, j, r + 1, o[3], -score, -o[0]) for r, o in enumerate(fits[:10])]
    return sorted(map(repr, found))


def mined(df):
    return sorted(repr(tuple(r)) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect())


def random_rows(seed, n, width=8, near=2):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        vec = [draw.gauss(0.5, 1) for _ in range(width)]
        rows.append((k * 10, vec if draw.random() < 0.8 else [1.0] * width, draw.randrange(near)))
    return rows


@pytest.mark.parametrize("largest, width", [(1, 3), (154, 64), (70_000, 200), (1 << 24, 33)])
def test_products_are_exact(largest, width):
    draw = np.random.default_rng(1)
    a, b = (draw.integers(-largest, largest + 1, (n, width)) for n in (7, 11))
    a[0], b[0], b[1] = largest, largest, -largest
    residues = Residues(largest, width)
    scores = residues.scores(residues.of(a), residues.of(b))
    assert scores.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]


def test_many_components_are_added_up_in_steps():
    a = np.full((1, 5000), 125)
    residues = Residues(125, 5000)
    assert residues.scores(residues.of(a), residues.of(a)).tolist() == [[125 * 125 * 5000]]


def test_moduli():
    assert all(all(p % q for q in range(2, p)) for p in PRIMES) and math.prod(PRIMES) < 1 << 63
    with pytest.raises(ValueError, match="64 bits"):
        Residues(1 << 31, 64)


@pytest.mark.parametrize("bound", [10, 1 << 61])
def test_best_first_breaks_ties_by_column(bound):
    scores = np.array([[3, 5, 5, 1, 5], [0, 0, 0, 0, 0]])
    assert best_first(scores, 3, bound).tolist() == [[1, 2, 4], [0, 1, 2]]
    assert best_first(scores, 9, bound).shape == (2, 5)


def test_against_brute_force(spark):
    rows = random_rows(2, 700)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows) != []


def test_small_packs_and_tiles_give_the_same(spark, monkeypatch):
    rows = random_rows(3, 300)
    whole = mined(spark.createDataFrame(rows, SCHEMA))
    monkeypatch.setattr(hard_negatives, "PACK", 7)
    monkeypatch.setattr(hard_negatives, "SALT_ROWS", 40)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == whole == brute(rows)


def test_rows_that_take_no_part_missing_ids_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(4, 60, 3, 3)
    rows += [(100, [1.0, None, 2.0], 1), (200, None, 1), (300, [1.0, nan, 0.0], 1), (400, [inf, 0.0, 0.0], 0)]
    rows += [(500, [1.0, 2.0, 3.0], None), (None, [1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0], 1), (7, [], 1)]
    rows += [(700, [1.0, 2.0], 2), (800, [], 0)] + [(100, [1.0, 1.0, 1.0], 1)] * 4
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) != []


def test_empty_table_no_anchor_and_clashing_names(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 1)], SCHEMA)) == []
    rows = random_rows(5, 80)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rid", "2 AS vec", "3 AS score", "4 AS rank", "5 AS anchor")
    assert mined(df) == brute(rows)
