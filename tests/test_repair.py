import datetime
import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import repair
from claimloom.schemas import CLAIMANT

START = datetime.date(2024, 1, 1)


def day(n):
    return START + datetime.timedelta(days=n)


def dim(spark, rows):
    """rows: (key, id, from day, to day or None, current)"""
    return spark.createDataFrame(
        [(k, i, "F", day(a), None if b is None else day(b), c) for k, i, a, b, c in rows],
        "claimant_key bigint, claimant_id bigint, gender string, effective_from date, effective_to date, "
        "is_current boolean",
    )


def test_duplicates(spark):
    rows = [(1, 1, 0, None, True), (2, 1, 5, None, True), (3, 2, 0, None, True), (4, 2, 0, 3, False)]
    assert [tuple(r) for r in repair.duplicate_current(dim(spark, rows), CLAIMANT).collect()] == [(1, 2)]


def test_gaps(spark):
    rows = [
        (1, 1, 0, 9, False), (2, 1, 10, 19, False), (3, 1, 25, None, True),  # 20..24 missing
        (4, 2, 0, 30, False), (5, 2, 5, 10, False), (6, 2, 31, None, True),  # covered by the long one
        (7, 3, 5, 4, False), (8, 3, 8, None, True),  # 5..7: the first covers nothing
    ]
    out = repair.history_gaps(dim(spark, rows), CLAIMANT).collect()
    assert sorted(tuple(r) for r in out) == [(1, day(20), day(24), 5), (3, day(5), day(7), 3)]


def test_open_versions_never_overlap(spark):
    rows = [(1, 1, 0, None, True), (2, 1, 5, None, True), (3, 1, 3, 8, False)]
    assert repair.overlaps(dim(spark, rows), CLAIMANT).count() == 0


@pytest.mark.parametrize("bin_days", [1, 7, 64])
def test_overlaps_equal_brute_force(spark, bin_days):
    """Long, short, empty and backward validity; one key holds a third of the rows."""
    rnd = random.Random(bin_days)
    rows = []
    for key in range(150):
        a = rnd.randrange(0, 300)
        b = rnd.choice([None, a + rnd.randrange(-10, 3), a + rnd.randrange(0, 20), a + rnd.randrange(0, 200)])
        rows.append((key, 0 if key % 3 == 0 else rnd.randrange(1, 9), a, b, b is None))
    expected = sorted(
        (i, k, l)
        for k, i, a, b, _ in rows
        for l, j, c, d, _ in rows  # noqa: E741
        if i == j and k != l and b is not None and d is not None and a < d and b > c
    )
    out = repair.overlaps(dim(spark, rows), CLAIMANT, bin_days).select("claimant_id", "a_key", "b_key")
    assert sorted(tuple(r) for r in out.collect()) == expected


def test_close_and_correct(spark):
    rows = [(1, 1, 0, None, True), (2, 1, 5, None, True), (3, 2, 0, 4, False)]
    closed = {r.claimant_key: r for r in
              repair.close_versions(dim(spark, rows), F.col("claimant_key") == 1, day(9)).collect()}
    assert (closed[1].is_current, closed[1].effective_to) == (False, day(9))
    assert (closed[2].is_current, closed[2].effective_to) == (True, None)
    by_id = (F.col("claimant_id") == 2) & F.col("is_current")
    assert repair.close_versions(dim(spark, rows), by_id, day(9)).filter("claimant_key = 3").first().effective_to == day(4)
    fixed = repair.correct_versions(dim(spark, rows), F.col("claimant_key") == 2, "gender", F.lit("M")).collect()
    assert {r.claimant_key: r.gender for r in fixed} == {1: "F", 2: "M", 3: "F"}


def test_latest_open_version_stays(spark):
    rows = [(1, 1, 0, None, True), (2, 1, 5, None, True), (3, 1, 2, None, True), (4, 2, 0, None, True),
            (5, 1, 9, 10, False)]
    repaired = repair.keep_latest_current(dim(spark, rows), CLAIMANT, day(20))
    out = {r.claimant_key: (r.is_current, r.effective_to) for r in repaired.collect()}
    assert out == {1: (False, day(20)), 2: (True, None), 3: (False, day(20)), 4: (True, None), 5: (False, day(10))}
    assert repair.duplicate_current(repaired, CLAIMANT).count() == 0


def test_version_history_in_order(spark):
    rows = [(1, 1, 5, 9, False), (2, 1, 0, 4, False), (3, 1, 10, None, True), (4, 2, 0, None, True)]
    where = F.col("claimant_id") == 1
    ahead = repair.version_history(dim(spark, rows), CLAIMANT, where).collect()
    back = repair.version_history(dim(spark, rows), CLAIMANT, where, newest_first=True).collect()
    assert [r.claimant_key for r in ahead] == [2, 1, 3]
    assert [r.claimant_key for r in back] == [3, 1, 2]
