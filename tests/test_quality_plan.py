import re

from test_quality import CLAIM, tables

from claimloom.operators import quality
from claimloom.sources.paths import land


def test_one_scan_per_table_and_one_shuffle_for_all_checks(spark, tmp_path):
    landed = {name: land(df, f"{tmp_path}/{name}") for name, df in tables(spark).items()}
    report = quality.report(landed, 1)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == len(landed)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Join" not in plan
    assert "report_date_key" not in plan and "payment_amount" not in plan


def test_null_and_repeated_keys(spark):
    claims = [CLAIM, {**CLAIM, "claim_key": 2}, {**CLAIM, "claim_key": 3, "claimant_key": None, "incident_date_key": None}]
    payments = [dict(payment_key=i, payment_id=i, claim_key=k) for i, k in enumerate((1, 1, 3, None, None, 9))]
    found = quality.report(tables(spark, claims=claims, payments=payments, policies=[(1, 1, False)]), 4).collect()
    rows = {r.check_name: (r.result, r.value, r.expected) for r in found}
    assert rows["fact_claim PK uniqueness"] == ("FAIL", 3, 1)
    assert rows["fact_claim row count"] == ("FAIL", 3, 4)
    assert rows["fact_claim FK claimant_key"] == ("PASS", 0, 0)
    assert rows["fact_claim valid date keys"] == ("PASS", 0, 0)
    assert rows["fact_payment FK claim_key"] == ("FAIL", 3, 0)
    assert rows["dim_policy SCD2 integrity"] == ("FAIL", None, 1)


def test_empty_tables(spark):
    found = quality.report({name: df.limit(0) for name, df in tables(spark).items()}, 1).collect()
    rows = {r.check_name: (r.result, r.value) for r in found}
    assert len(rows) == 13
    assert rows["fact_claim PK uniqueness"] == ("PASS", 0)
    assert rows["fact_claim row count"] == ("FAIL", 0)
    assert rows["dim_employer SCD2 integrity"] == ("FAIL", None)
    assert rows["fact_payment FK claim_key"] == ("PASS", 0)
