"""Reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def claims_summary(claim: DataFrame, employer: DataFrame, policy: DataFrame) -> DataFrame:
    """Claims per company, industry, coverage, type, status and severity.

    Claims are summed up per key pair first, so the joins see groups instead of
    claims and a hot employer or policy has shrunk to a few rows before it is moved.
    """
    detail = ["claim_type", "claim_status", "claim_severity"]
    per_key = claim.groupBy("employer_key", "policy_key", *detail).agg(
        F.count(F.lit(1)).alias("_claims"),
        F.sum("claim_amount").alias("_claimed"),
        F.count("claim_amount").alias("_amounts"),
        F.sum("approved_amount").alias("_approved"),
    )
    employers = employer.filter(F.col("is_current")).select("employer_key", "company_name", "industry")
    policies = policy.filter(F.col("is_current")).select("policy_key", "coverage_type")
    claimed = F.sum("_claimed").cast("decimal(38,2)")
    amounts = F.sum("_amounts").cast("decimal(20,0)")
    return (
        per_key.join(employers, "employer_key")
        .join(policies, "policy_key")
        .groupBy("company_name", "industry", "coverage_type", *detail)
        .agg(
            F.sum("_claims").alias("total_claims"),
            claimed.alias("total_claimed"),
            F.sum("_approved").cast("decimal(38,2)").alias("total_approved"),
            F.when(amounts > 0, (claimed / amounts).cast("decimal(16,6)")).alias("avg_claim_amount"),
        )
    )
