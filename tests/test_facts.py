import datetime
from decimal import Decimal

from claimloom.operators import calendar
from claimloom.plans import facts, views

D = datetime.date


def star(spark, claimants=None):
    claimant = spark.createDataFrame(
        claimants or [(1, 10, 7, True), (2, 11, 8, True), (3, 12, 7, False)],
        "claimant_key bigint, claimant_id bigint, employer_id bigint, is_current boolean",
    )
    policy = spark.createDataFrame(
        [(1, 100, "Full", True), (2, 101, "Partial", True), (3, 102, "Full", False)],
        "policy_key bigint, policy_id bigint, coverage_type string, is_current boolean",
    )
    employer = spark.createDataFrame(
        [(1, 7, "Acme", "Retail", True), (2, 8, "Bolt", "Retail", False)],
        "employer_key bigint, employer_id bigint, company_name string, industry string, is_current boolean",
    )
    return claimant, policy, employer


def claims(spark, rows):
    """rows: (claim_id, claimant_id, policy_id, incident_date, amount)"""
    full = [(c, p, q, i, D(2024, 1, 9), "medical", "open", "low", a, 1.0) for c, p, q, i, a in rows]
    return spark.createDataFrame(
        full,
        "claim_id bigint, claimant_id bigint, policy_id bigint, incident_date date, report_date date, "
        "claim_type string, claim_status string, claim_severity string, claim_amount double, approved_amount double",
    )


def test_claims_without_open_claimant_policy_or_employer_are_left_out(spark):
    rows = [
        (1, 10, 100, D(2024, 1, 5), 10.0),
        (2, 12, 100, D(2024, 1, 5), 10.0),  # claimant closed
        (3, 10, 102, D(2024, 1, 5), 10.0),  # policy closed
        (4, 11, 100, D(2024, 1, 5), 10.0),  # employer closed
        (5, 99, 100, D(2024, 1, 5), 10.0),  # claimant unknown
        (6, 10, None, D(2024, 1, 5), 10.0),
    ]
    fact = facts.fact_claim(facts.place_claims(claims(spark, rows), *star(spark)))
    assert [(r.claim_id, r.claimant_key, r.policy_key, r.employer_key) for r in fact.collect()] == [(1, 1, 1, 1)]
    key = fact.first().claim_key
    payments = spark.createDataFrame(
        [(1, 1, D(2024, 2, 1), 5.0, "medical"), (2, 2, D(2024, 2, 1), 5.0, "medical"), (3, None, None, 5.0, "x")],
        "payment_id bigint, claim_id bigint, payment_date date, payment_amount double, payment_type string",
    )
    paid = facts.fact_payment(facts.place_payments(payments, fact)).collect()
    assert [(r.payment_id, r.claim_key, r.payment_date_key) for r in paid] == [(1, key, 20240201)]


def test_two_open_rows_of_a_claimant_double_the_claim(spark):
    dims = star(spark, [(1, 10, 7, True), (2, 10, 7, True)])
    fact = facts.fact_claim(facts.place_claims(claims(spark, [(1, 10, 100, D(2024, 1, 5), 10.0)]), *dims))
    rows = fact.collect()
    assert [r.claim_id for r in rows] == [1, 1] and len({r.claim_key for r in rows}) == 2


def test_ordered_claims_are_numbered_by_claim_id(spark):
    rows = [(i, 10, 100, D(2024, 1, 5), 10.0) for i in (5, 3, 9, 1)]
    fact = facts.fact_claim(facts.place_claims(claims(spark, rows), *star(spark)), ordered=True)
    assert sorted((r.claim_key, r.claim_id) for r in fact.collect()) == [(1, 1), (2, 3), (3, 5), (4, 9)]


def test_dates_and_amounts(spark):
    rows = [(1, 10, 100, None, 2.675), (2, 10, 100, D(1999, 12, 31), None)]
    fact = {r.claim_id: r for r in facts.place_claims(claims(spark, rows), *star(spark)).collect()}
    assert (fact[1].incident_date_key, fact[1].claim_amount) == (None, Decimal("2.68"))
    assert (fact[2].incident_date_key, fact[2].claim_amount) == (19991231, None)


def test_summary(spark):
    dims = star(spark)
    rows = [(1, 10, 100, D(2024, 1, 5), 10.0), (2, 10, 100, D(2024, 1, 6), 11.0), (3, 10, 101, None, None)]
    fact = facts.fact_claim(facts.place_claims(claims(spark, rows), *dims))
    out = {r.coverage_type: r for r in views.claims_summary(fact, dims[2], dims[1]).collect()}
    full, partial = out["Full"], out["Partial"]
    assert (full.company_name, full.total_claims, full.total_claimed) == ("Acme", 2, Decimal("21.00"))
    assert (full.total_approved, full.avg_claim_amount) == (Decimal("2.00"), Decimal("10.500000"))
    assert (partial.total_claims, partial.total_claimed, partial.avg_claim_amount) == (1, None, None)


def test_calendar(spark):
    rows = {r.date_key: r for r in calendar.dim_date(spark).collect()}
    assert len(rows) == 4018 and min(rows) == 20200101 and max(rows) == 20301231
    leap = rows[20240229]
    assert (leap.year, leap.quarter, leap.month, leap.month_name, leap.day_of_month) == (2024, 1, 2, "February", 29)
    assert (leap.day_of_week, leap.day_name, leap.is_weekend, leap.is_month_end) == (4, "Thursday", False, True)
    sunday = rows[20240303]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sunday", True)
