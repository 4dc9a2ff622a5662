"""From delivered rows to typed, versioned entity tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.cleaning import conform, trimmed, try_convert
from claimloom.operators.versions import flag_newest, keep_newest, newest_by_hash, newest_first
from claimloom.schemas import STAGING

_DERIVED = ("effective_from", "effective_to", "is_current")


def _source_columns(entity: str) -> T.StructType:
    return T.StructType([f for f in STAGING[entity].fields if f.name not in _DERIVED])


def _clean(raw: DataFrame, entity: str, **derived: Column) -> DataFrame:
    return conform(raw, _source_columns(entity), **derived)


def _versions(
    rows: DataFrame, key: str, effective_from: Column, effective_to: Column, landing: str | None
) -> DataFrame:
    """All versions of every key, the newest flagged, with their initial validity.

    The cleaned rows land in ``landing``, a new work folder if it is not given.
    """
    known = rows.filter(F.col(key).isNotNull())
    flagged = flag_newest(known, key, newest_by_hash(known, "updated_at", key), "is_current", landing)
    columns = [c for c in known.columns if c not in _DERIVED]
    return flagged.select(
        *columns,
        effective_from.alias("effective_from"),
        effective_to.cast("date").alias("effective_to"),
        "is_current",
    )


#: Entities whose rows without a readable key are left out; claims without one fail the load.
KEYED = {"claimants": "claimant_id", "employers": "employer_id", "payments": "payment_id", "policies": "policy_id"}


def delivered_key(raw: DataFrame, entity: str) -> Column | None:
    """The key of a delivered row as its entity has it, NULL where it is not readable."""
    fields = {f.name: f for f in raw.schema.fields}
    return _typed(fields, KEYED[entity], T.LongType()) if entity in KEYED else None


def _first_seen(as_of: datetime.date) -> Column:
    return F.coalesce(F.to_date("created_at"), F.to_date("updated_at"), F.lit(as_of))


def claimants(raw: DataFrame, as_of: datetime.date, landing: str | None = None) -> DataFrame:
    rows = _clean(raw, "claimants").withColumn("gender", F.coalesce("gender", F.lit("Unknown")))
    return _versions(rows, "claimant_id", _first_seen(as_of), F.lit(None), landing)


def employers(raw: DataFrame, as_of: datetime.date, landing: str | None = None) -> DataFrame:
    rows = _clean(raw, "employers")
    return _versions(rows, "employer_id", _first_seen(as_of), F.lit(None), landing)


def policies(raw: DataFrame, as_of: datetime.date, landing: str | None = None) -> DataFrame:
    rows = _clean(raw, "policies")
    start = F.coalesce(F.col("start_date"), F.lit(as_of))
    return _versions(rows, "policy_id", start, F.col("end_date"), landing)


def payments(raw: DataFrame) -> DataFrame:
    """One row per payment_id; of several the newest, ties settled by content."""
    rows = _clean(raw, "payments").filter(F.col("payment_id").isNotNull())
    return keep_newest(rows, "payment_id", newest_first(rows, "created_at", "payment_id"))


def _claim_file(raw: DataFrame, **derived: Column) -> DataFrame:
    """One claims file, cleaned; ``_match`` identifies a claim even if its id is not a number."""
    fields = {f.name: f for f in raw.schema.fields}
    claim_id = _typed(fields, "claim_id", T.LongType()).cast("string")
    if "claim_id" in fields and isinstance(fields["claim_id"].dataType, T.StringType):
        claim_id = F.coalesce(claim_id, trimmed(fields["claim_id"]))
    # No approval yet means nothing approved; text that is no number stays unknown.
    approved = F.lit(0.0)
    if "approved_amount" in fields:
        amount = _typed(fields, "approved_amount", T.DoubleType())
        approved = F.when(trimmed(fields["approved_amount"]).isNotNull(), amount).otherwise(approved)
    status = F.lower(_typed(fields, "claim_status", T.StringType()))
    return _clean(raw, "claims", _match=claim_id, approved_amount=approved, claim_status=status, **derived)


def _typed(fields: dict[str, T.StructField], name: str, target: T.DataType) -> Column:
    if name not in fields:
        return F.lit(None).cast(target)
    return try_convert(trimmed(fields[name]), fields[name].dataType, target)


def all_claims(v1: DataFrame, v2: DataFrame, v2_again: DataFrame | None = None) -> DataFrame:
    """Both claim files in one: v2 has the last word on claims that are in both.

    Claim ids of v2 are made distinct before the join, so copies there do not pile
    up on its build side; a hot id in v1 is on the side AQE can split.  They are read from
    ``v2_again``, the same file, if ``v2`` is to be read once, as where its lines are counted.
    """
    newer = _claim_file(v2)
    older = _claim_file(v1, claim_severity=F.lit("unknown"))
    superseded = _claim_file(v2 if v2_again is None else v2_again).select("_match").filter(F.col("_match").isNotNull()).distinct()
    only_older = older.join(superseded, "_match", "left_anti")
    return newer.unionByName(only_older, allowMissingColumns=True).drop("_match")


def claims(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Unified claims that name a policy; the others cannot be placed in the star."""
    return all_claims(v1, v2).filter(F.col("policy_id").isNotNull())
