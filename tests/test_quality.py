import datetime

import pytest

from claimloom.operators import calendar, quality
from claimloom.schemas import WAREHOUSE, no_rows

DAY = datetime.date(2024, 1, 1)
CLAIM = dict(claim_key=1, claim_id=1, claimant_key=1, policy_key=1, employer_key=1, incident_date_key=20240101,
             report_date_key=20240101, claim_type="m", claim_status="open", claim_severity="low",
             claim_amount=1, approved_amount=1)


def frame(spark, table, rows):
    from decimal import Decimal

    schema = no_rows(spark, WAREHOUSE[table]).schema
    money = {"claim_amount", "approved_amount", "payment_amount", "premium_amount"}
    return spark.createDataFrame(
        [tuple(Decimal(r[f]) if f in money and r.get(f) is not None else r.get(f) for f in schema.fieldNames())
         for r in rows],
        schema,
    )


def tables(spark, claims=None, claimants=None, policies=None, employers=None, payments=None):
    dim = lambda key, idc, rows: [
        {key: k, idc: i, "effective_from": DAY, "is_current": c} for k, i, c in rows
    ]
    return {
        "fact_claim": frame(spark, "fact_claim", [CLAIM] if claims is None else claims),
        "fact_payment": frame(
            spark, "fact_payment", [dict(payment_key=1, payment_id=1, claim_key=1)] if payments is None else payments
        ),
        "dim_claimant": frame(spark, "dim_claimant", dim("claimant_key", "claimant_id", claimants or [(1, 1, True)])),
        "dim_policy": frame(
            spark, "dim_policy", dim("policy_key", "policy_id", [(1, 1, True)] if policies is None else policies)
        ),
        "dim_employer": frame(spark, "dim_employer", dim("employer_key", "employer_id", employers or [(1, 1, True)])),
        "dim_date": calendar.dim_date(spark),
    }


def failed(spark, floor=1, **changes):
    rows = quality.report(tables(spark, **changes), floor).collect()
    assert len(rows) == 13
    return {r.check_name for r in rows if r.result == "FAIL"}


def test_all_pass(spark):
    assert failed(spark) == set()
    assert len(quality.gate(quality.report(tables(spark), 1))) == 13


def test_claim_faults(spark):
    claims = [
        CLAIM,
        {**CLAIM, "claim_key": 2, "claim_status": "pending", "claim_amount": -1},
        {**CLAIM, "claim_key": 3, "claim_id": None, "incident_date_key": 20310101, "claimant_key": 9},
    ]
    assert failed(spark, claims=claims, floor=4) == {
        "fact_claim PK uniqueness",
        "fact_claim FK claimant_key",
        "fact_claim non-negative amounts",
        "fact_claim row count",
        "fact_claim valid date keys",
        "claim_status standardized",
        "fact_claim no NULL claim_id",
    }


def test_nulls_that_are_no_fault(spark):
    claims = [{**CLAIM, "claim_status": None, "claimant_key": None, "incident_date_key": None, "claim_amount": None}]
    assert failed(spark, claims=claims) == set()


def test_payment_without_claim_key_is_an_orphan(spark):
    payments = [dict(payment_key=1, payment_id=1, claim_key=None), dict(payment_key=2, payment_id=2, claim_key=5)]
    report = quality.report(tables(spark, payments=payments), 1)
    row = report.filter("check_name = 'fact_payment FK claim_key'").first()
    assert (row.result, row.value) == ("FAIL", 2)


def test_history_faults(spark):
    assert failed(spark, claimants=[(1, 1, True), (2, 1, True)]) == {"dim_claimant SCD2 integrity"}
    assert failed(spark, employers=[(1, 1, True), (2, 1, True)]) == {"dim_employer SCD2 integrity"}
    # A key with no open row passes as long as another key has one; an empty dimension fails.
    assert failed(spark, policies=[(1, 1, True), (2, 2, False)]) == set()
    assert failed(spark, policies=[]) == {"dim_policy SCD2 integrity"}
    assert failed(spark, policies=[(1, 1, True), (2, None, True)]) == {"dim_policy no NULL policy_id"}


def test_gate_names_the_failed_checks(spark):
    with pytest.raises(quality.QualityError, match="12/13 checks passed; failed: fact_claim row count"):
        quality.gate(quality.report(tables(spark), 2000))
