"""Facts, rebuilt in full against the open rows of the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.cleaning import date_key
from claimloom.operators.keys import number_rows
from claimloom.schemas import WAREHOUSE
from claimloom.sources.paths import land, work_folder


def _open_rows(dim: DataFrame, *columns: str) -> DataFrame:
    return dim.filter(F.col("is_current")).select(*columns)


def place_claims(claims: DataFrame, claimant: DataFrame, policy: DataFrame, employer: DataFrame) -> DataFrame:
    """Claims with the keys of their claimant, policy and the claimant's employer.

    The two dimensions are joined to each other first: claims then meet one combined
    claimant side and one policy side, two shuffles of the large table at most.  No
    broadcast is forced; AQE picks it where the measured side is small, and splits a
    hot claimant or policy on the claims side otherwise.
    """
    claimants = _open_rows(claimant, "claimant_id", "claimant_key", "employer_id")
    employers = _open_rows(employer, "employer_id", "employer_key")
    employed = claimants.join(employers, "employer_id").select("claimant_id", "claimant_key", "employer_key")
    policies = _open_rows(policy, "policy_id", "policy_key")
    return (
        claims.join(policies, "policy_id")
        .join(employed, "claimant_id")
        .select(
            "claim_id",
            "claimant_key",
            "policy_key",
            "employer_key",
            date_key(F.col("incident_date")).alias("incident_date_key"),
            date_key(F.col("report_date")).alias("report_date_key"),
            "claim_type",
            "claim_status",
            "claim_severity",
            F.col("claim_amount").cast("decimal(12,2)").alias("claim_amount"),
            F.col("approved_amount").cast("decimal(12,2)").alias("approved_amount"),
        )
    )


def _as_written(placed: DataFrame, key: str, table: str) -> DataFrame:
    """Rows with ``key``, unique and rising but not dense, to be written once as they are.

    The number holds the task and the place in it, so it takes no job of its own.  It is
    fixed by the write: whoever needs the key reads the written table.
    """
    number = (F.monotonically_increasing_id() + 1).alias(key)
    return placed.select(number, "*").select(*WAREHOUSE[table].fieldNames())


def claim_rows(placed: DataFrame) -> DataFrame:
    """Placed claims with claim_key, for the one write of a load."""
    return _as_written(placed, "claim_key", "fact_claim")


def fact_claim(placed: DataFrame, landing: str | None = None, ordered: bool = False) -> DataFrame:
    """The claims table, landed; ``ordered`` numbers it densely by claim_id instead."""
    landing = landing or work_folder(placed.sparkSession, "fact_claim")
    if not ordered:
        return land(claim_rows(placed), landing)
    return number_rows(placed, "claim_key", 0, ["claim_id"], landing).select(*WAREHOUSE["fact_claim"].fieldNames())


def place_payments(payments: DataFrame, claim: DataFrame) -> DataFrame:
    """Payments with the key of their claim; payments of claims left out go with them."""
    keys = claim.select("claim_id", "claim_key")
    return payments.join(keys, "claim_id").select(
        "payment_id",
        "claim_key",
        date_key(F.col("payment_date")).alias("payment_date_key"),
        F.col("payment_amount").cast("decimal(12,2)").alias("payment_amount"),
        "payment_type",
    )


def payment_rows(placed: DataFrame) -> DataFrame:
    """Placed payments with payment_key, for the one write of a load."""
    return _as_written(placed, "payment_key", "fact_payment")


def fact_payment(placed: DataFrame, landing: str | None = None, ordered: bool = False) -> DataFrame:
    """The payments table, landed; ``ordered`` numbers it densely by payment_id instead."""
    landing = landing or work_folder(placed.sparkSession, "fact_payment")
    if not ordered:
        return land(payment_rows(placed), landing)
    return number_rows(placed, "payment_key", 0, ["payment_id"], landing).select(*WAREHOUSE["fact_payment"].fieldNames())
