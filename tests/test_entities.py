import datetime

from conftest import text_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimloom.operators.versions import flag_newest, keep_newest, newest_by_hash, newest_first
from claimloom.plans import entities
from claimloom.schemas import FILE_HEADERS

DAY = datetime.date(2024, 2, 1)
CLAIMANT = FILE_HEADERS["claimants.csv"]
V1, V2 = FILE_HEADERS["claims_v1.csv"], FILE_HEADERS["claims_v2.csv"]


def claimant(key, updated="2024-01-02 00:00:00", created="2024-01-01 00:00:00", first="Ann", gender="F", employer="1"):
    return (key, first, "Lee", "1990-01-01", gender, "2015-01-01", employer, created, updated)


def claim(key, policy="1", status="Open", approved="5.0", incident="2024-01-01", amount="10.0", severity=None):
    row = (key, "1", policy, incident, "2024-01-03", "medical", status, amount, approved,
           "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    return row if severity is None else (*row, severity)


def test_trim_takes_blanks_but_not_tabs(spark):
    rows = [claimant("1", first="  Ann "), claimant("2", first="\tBob ")]
    names = {r.claimant_id: r.first_name for r in entities.claimants(text_rows(spark, CLAIMANT, rows), DAY).collect()}
    assert names == {1: "Ann", 2: "\tBob"}


def test_gender_null_is_unknown_blank_is_empty(spark):
    rows = [claimant("1", gender=None), claimant("2", gender="  ")]
    out = {r.claimant_id: r.gender for r in entities.claimants(text_rows(spark, CLAIMANT, rows), DAY).collect()}
    assert out == {1: "Unknown", 2: ""}


def test_rows_without_numeric_key_are_dropped(spark):
    rows = [claimant("1"), claimant(None), claimant("abc"), claimant("7.0"), claimant("8", employer="12.0")]
    out = {r.claimant_id: r.employer_id for r in entities.claimants(text_rows(spark, CLAIMANT, rows), DAY).collect()}
    assert out == {1: 1, 7: 1, 8: 12}


def test_newest_version_is_current_and_null_updated_at_is_oldest(spark):
    rows = [
        claimant("1", updated="2024-01-05 00:00:00", first="new"),
        claimant("1", updated="2024-01-04 00:00:00", first="old"),
        claimant("1", updated=None, first="none"),
        claimant("2", updated=None, first="only"),
    ]
    out = entities.claimants(text_rows(spark, CLAIMANT, rows), DAY).collect()
    assert {r.first_name: r.is_current for r in out} == {"new": True, "old": False, "none": False, "only": True}


def test_effective_from_falls_back(spark):
    rows = [
        claimant("1", created="2023-05-05 10:00:00"),
        claimant("2", created=None, updated="2023-06-06 10:00:00"),
        claimant("3", created=None, updated=None),
    ]
    out = {r.claimant_id: r for r in entities.claimants(text_rows(spark, CLAIMANT, rows), DAY).collect()}
    assert out[1].effective_from == datetime.date(2023, 5, 5)
    assert out[2].effective_from == datetime.date(2023, 6, 6)
    assert out[3].effective_from == DAY
    assert all(r.effective_to is None for r in out.values())


def test_policy_validity_comes_from_its_term(spark):
    header = FILE_HEADERS["policies.csv"]
    rows = [
        ("1", "P1", "Full", "2020-01-01", "2021-01-01", "10.5", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("2", "P2", "Full", None, None, "x", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
    ]
    out = {r.policy_id: r for r in entities.policies(text_rows(spark, header, rows), DAY).collect()}
    assert (out[1].effective_from, out[1].effective_to) == (datetime.date(2020, 1, 1), datetime.date(2021, 1, 1))
    assert (out[2].effective_from, out[2].effective_to, out[2].premium_amount) == (DAY, None, None)


def test_missing_columns_become_typed_nulls_and_new_ones_flow_on(spark):
    raw = text_rows(spark, "employer_id,company_name,created_at,updated_at,region",
                    [("1", "Acme", "2024-01-01 00:00:00", "2024-01-01 00:00:00", " north ")])
    out = entities.employers(raw, DAY)
    row = out.first()
    assert (row.employer_id, row.policy_id, row.industry, row.region) == (1, None, None, "north")
    assert dict(out.dtypes)["policy_id"] == "bigint"


def test_second_claims_file_has_the_last_word(spark):
    v1 = text_rows(spark, V1, [claim("1", amount="1"), claim("2", amount="2"), claim(None, amount="3")])
    v2 = text_rows(spark, V2, [claim("2.0", amount="20", severity="high"), claim("3", amount="30", severity="low")])
    out = [(r.claim_id, r.claim_amount, r.claim_severity) for r in entities.claims(v1, v2).collect()]
    assert sorted(out, key=str) == [
        (1, 1.0, "unknown"), (2, 20.0, "high"), (3, 30.0, "low"), (None, 3.0, "unknown"),
    ]


def test_claim_repeated_within_second_file_stays_twice(spark):
    v1 = text_rows(spark, V1, [claim("2")])
    v2 = text_rows(spark, V2, [claim("2", severity="low"), claim("2", severity="low")])
    assert entities.claims(v1, v2).count() == 2


def test_severity_of_first_file_is_overwritten(spark):
    v1 = text_rows(spark, V2, [claim("1", severity="high")])
    v2 = text_rows(spark, V2, [claim("2", severity="high")])
    assert {r.claim_id: r.claim_severity for r in entities.claims(v1, v2).collect()} == {1: "unknown", 2: "high"}


def test_text_ids_match_between_files_as_text(spark):
    v1 = text_rows(spark, V1, [claim("abc"), claim("abd")])
    v2 = text_rows(spark, V2, [claim("abc", severity="low")])
    out = entities.claims(v1, v2).collect()
    assert sorted((r.claim_id, r.claim_severity) for r in out) == [
        (None, "low"), (None, "unknown"),
    ]


def test_approved_amount_null_is_zero_but_bad_text_is_null(spark):
    v1 = text_rows(spark, V1, [claim("1", approved=None), claim("2", approved="N/A"), claim("3", approved=" 7.5 ")])
    v2 = text_rows(spark, V2, [claim("9", severity="low")])
    out = {r.claim_id: r.approved_amount for r in entities.claims(v1, v2).collect()}
    assert out == {1: 0.0, 2: None, 3: 7.5, 9: 5.0}


def test_claims_without_policy_go_but_still_supersede(spark):
    v1 = text_rows(spark, V1, [claim("1"), claim("2", policy=None)])
    v2 = text_rows(spark, V2, [claim("1", policy=None, severity="low"), claim("3", status=" CLOSED ", severity="low")])
    out = [(r.claim_id, r.claim_status) for r in entities.claims(v1, v2).collect()]
    assert out == [(3, "closed")]


def test_extra_column_in_one_claims_file_reads_null_in_the_other(spark):
    v1 = text_rows(spark, V1, [claim("1")])
    v2 = text_rows(spark, V2 + ",adjuster", [(*claim("2", severity="low"), "Kim")])
    assert {r.claim_id: r.adjuster for r in entities.claims(v1, v2).collect()} == {1: None, 2: "Kim"}


def test_unparseable_dates_and_numbers_become_null(spark):
    v1 = text_rows(spark, V1, [claim("1", incident="soon", amount="much")])
    v2 = text_rows(spark, V2, [claim("2", severity="low")])
    row = entities.claims(v1, v2).filter("claim_id = 1").first()
    assert (row.incident_date, row.claim_amount) == (None, None)


def test_one_payment_per_id_the_newest(spark):
    header = FILE_HEADERS["payments.csv"]
    rows = [
        ("1", "5", "2024-01-01", "10", "a", "2024-01-01 00:00:00"),
        ("1", "5", "2024-01-01", "11", "a", "2024-01-02 00:00:00"),
        ("1", "5", "2024-01-01", "12", "a", None),
        ("2", "5", "2024-01-01", "20", "a", "2024-01-01 00:00:00"),
        ("2", "5", "2024-01-01", "20", "a", "2024-01-01 00:00:00"),
        (None, "5", "2024-01-01", "30", "a", "2024-01-01 00:00:00"),
    ]
    out = entities.payments(text_rows(spark, header, rows)).collect()
    assert sorted((r.payment_id, r.payment_amount) for r in out) == [(1, 11.0), (2, 20.0)]


def test_flags_are_those_of_one_window(spark):
    """A key with a third of all rows, many of them copies, and one clear winner."""
    rows = spark.range(0, 3000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("key"),
        (F.col("id") % 40).alias("updated_at"),
        (F.col("id") % 5).alias("content"),
    )
    order = newest_first(rows, "updated_at", "key")
    plain = rows.withColumn("is_current", F.row_number().over(Window.partitionBy("key").orderBy(*order)) == 1)
    flagged = flag_newest(rows, "key", order)
    as_rows = lambda df: sorted(tuple(r) for r in df.select("key", "updated_at", "content", "is_current").collect())
    assert as_rows(flagged) == as_rows(plain)


def test_no_task_gets_all_rows_of_a_hot_key(spark):
    """Two million copies of one row, a few bytes on disk: they are dealt out evenly."""
    rows = spark.range(0, 2_000_000, 1, 8).select(F.lit(1).alias("key"), F.lit(2).alias("updated_at"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_newest(rows, "key", newest_first(rows, "updated_at", "key"))
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(sizes) == 2_000_000 and max(sizes) < 1_000_000
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_copies_of_the_newest_row_yield_one_current_row(spark):
    rows = spark.range(0, 1000, 1, 8).select(F.lit(1).alias("key"), F.lit(2).alias("updated_at"))
    flagged = flag_newest(rows, "key", newest_first(rows, "updated_at", "key"))
    assert flagged.groupBy("is_current").count().orderBy("is_current").collect() == [(False, 999), (True, 1)]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("key"), F.col("id").alias("created_at"))
    kept = keep_newest(rows, "key", newest_first(rows, "created_at", "key"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:], plan
    assert sorted(r.created_at for r in kept.collect()) == list(range(93, 100))


def test_only_narrow_rows_are_ranked(spark):
    rows = spark.range(500).select(
        (F.col("id") % 90).alias("key"),
        (F.col("id") % 7).alias("updated_at"),
        *[F.col("id").cast("string").alias(f"wide{i}") for i in range(9)],
    )
    flagged = flag_newest(rows, "key", newest_by_hash(rows, "updated_at", "key"))
    assert flagged.filter("is_current").select("key").distinct().count() == flagged.filter("is_current").count() == 90
    best = {r.key: r.m for r in rows.groupBy("key").agg(F.max("updated_at").alias("m")).collect()}
    assert all(best[r.key] == r.updated_at for r in flagged.filter("is_current").collect())
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    ranked = plan[plan.index("WindowGroupLimit") :]
    assert "_w0" in ranked and "wide1" not in ranked[: ranked.index("xxhash64")], plan
