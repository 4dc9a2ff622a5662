from pyspark.sql import functions as F

from claimloom.operators.keys import number_rows


def test_ordered_keys_equal_row_number(spark):
    rows = spark.range(0, 5000, 1, 6).select(((F.col("id") * 7919) % 5000).alias("claim_id"))
    out = number_rows(rows, "claim_key", 100, ["claim_id"]).collect()
    assert sorted((r.claim_key, r.claim_id) for r in out) == [(101 + i, i) for i in range(5000)]


def test_unordered_keys_are_dense_and_unique(spark):
    rows = spark.range(0, 1000, 1, 5).select((F.col("id") % 10).alias("x"))
    keys = [r.k for r in number_rows(rows, "k").collect()]
    assert sorted(keys) == list(range(1, 1001))


def test_hot_key_and_copies_are_spread_over_files(spark):
    """A third of the rows share one id and are copies of each other."""
    rows = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id") + 100).alias("claim_id")
    )
    out = number_rows(rows, "k", 0, ["claim_id"])
    assert sorted(r.k for r in out.select("k").collect()) == list(range(1, 6001))
    by_id = [r.claim_id for r in out.orderBy("k").collect()]
    assert by_id == sorted(by_id)


def test_same_rows_get_same_keys_again(spark):
    rows = spark.range(0, 2000, 1, 7).select(F.hash("id").alias("claim_id"))
    first = number_rows(rows, "k", 0, ["claim_id"]).collect()
    again = number_rows(rows.repartition(3), "k", 0, ["claim_id"]).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_no_rows(spark):
    assert number_rows(spark.range(0).select(F.col("id").alias("claim_id")), "k", 5, ["claim_id"]).collect() == []
