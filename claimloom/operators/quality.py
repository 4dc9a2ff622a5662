"""Post-load checks: one report row per check, and a gate that fails on any FAIL."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.schemas import CLAIMANT, EMPLOYER, POLICY

# Fewest claims a complete load has, and the statuses a claim may have.
ROW_FLOOR = 2000
CLAIM_STATUSES = ("open", "closed", "denied")


class QualityError(Exception):
    """At least one check failed."""


def _side(part: str, key: str, rows: int = 0, parents: int | Column = 0, **faults: Column) -> Column:
    """What one row of a table says about a key: of rows that are checked, or of those they refer to."""
    number = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("bigint")
    return F.struct(
        F.lit(part).alias("part"),
        F.col(key).cast("bigint").alias("key"),
        number(rows).alias("rows"),
        number(parents).alias("parents"),
        *[number(faults.get(name, 0)).alias(name) for name in ("negative", "bad_status")],
    )


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _sides(tables: dict[str, DataFrame]) -> DataFrame:
    """Every table read once, each of its rows turned into what it says about each of its keys."""
    negative = (F.col("claim_amount") < 0) | (F.col("approved_amount") < 0)
    bad_status = ~F.col("claim_status").isin(*CLAIM_STATUSES)
    said = {
        "fact_claim": [
            _side("claim", "claim_id", 1, negative=_flag(negative), bad_status=_flag(bad_status)),
            _side("claimant of claim", "claimant_key", 1),
            _side("date of claim", "incident_date_key", 1),
            _side("claim of payment", "claim_key", parents=1),
        ],
        "fact_payment": [_side("claim of payment", "claim_key", 1)],
        "dim_date": [_side("date of claim", "date_key", parents=1)],
    }
    for spec in (CLAIMANT, POLICY, EMPLOYER):
        said[spec.name] = [_side(spec.name, spec.natural_key, 1, _flag(F.col("is_current")))]
    said["dim_claimant"].append(_side("claimant of claim", "claimant_key", parents=1))
    found = None
    for name, sides in said.items():
        rows = tables[name].select(F.inline(F.array(*sides)))
        found = rows if found is None else found.unionByName(rows)
    return found


def _sum_of(part: str, value: str | Column, where: Column | None = None) -> Column:
    mine = F.col("part") == part
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(F.when(mine if where is None else mine & where, value)), F.lit(0))


def _row(name: str, passed: Column, value: Column, expected: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("result"),
        value.cast("bigint").alias("value"),
        expected.cast("bigint").alias("expected"),
    )


def _none(name: str, count: Column) -> Column:
    return _row(name, count == 0, count, F.lit(0))


def report(tables: dict[str, DataFrame], row_floor: int = ROW_FLOOR) -> DataFrame:
    """All checks on a loaded warehouse: (check_name, result, value, expected).

    One scan per table and one shuffle for all checks.  Rows are counted per key within the
    map tasks first, so a key that a third of all rows share moves as a row per task; claims
    and payments meet the rows they refer to in the count of their key, without a join.

    A NULL claim_key of a payment refers to nothing and counts as an orphan; NULL keys of
    claims are no orphans.  A dimension without open rows fails its check with a NULL value.
    """
    per_key = _sides(tables).groupBy("part", "key").agg(
        *[F.sum(name).alias(name) for name in ("rows", "parents", "negative", "bad_status")]
    )
    no_key, no_parent = F.col("key").isNull(), F.col("parents") == 0
    counts = {
        "rows": _sum_of("claim", "rows"),
        "keys": _sum_of("claim", F.lit(1), ~no_key),
        "negative": _sum_of("claim", "negative"),
        "bad_status": _sum_of("claim", "bad_status"),
        "no_claim_id": _sum_of("claim", "rows", no_key),
        "no_claimant": _sum_of("claimant of claim", "rows", ~no_key & no_parent),
        "no_date": _sum_of("date of claim", "rows", ~no_key & no_parent),
        "no_claim": _sum_of("claim of payment", "rows", no_key | no_parent),
    }
    for spec in (CLAIMANT, POLICY, EMPLOYER):
        open_rows = (F.col("part") == spec.name) & (F.col("parents") > 0)
        counts[f"open_{spec.name}"] = F.max(F.when(open_rows, F.col("parents")))
    for spec in (CLAIMANT, POLICY):
        counts[f"no_key_{spec.name}"] = _sum_of(spec.name, "rows", no_key)
    n = {name: F.col(name) for name in counts}
    rows = [
        _row("fact_claim PK uniqueness", n["rows"] == n["keys"], n["rows"], n["keys"]),
        _none("fact_claim non-negative amounts", n["negative"]),
        _row("fact_claim row count", n["rows"] >= row_floor, n["rows"], F.lit(row_floor)),
        _none("claim_status standardized", n["bad_status"]),
        _none("fact_claim no NULL claim_id", n["no_claim_id"]),
        _none("fact_claim FK claimant_key", n["no_claimant"]),
        _none("fact_claim valid date keys", n["no_date"]),
        _none("fact_payment FK claim_key", n["no_claim"]),
    ]
    for spec in (CLAIMANT, POLICY, EMPLOYER):
        most = n[f"open_{spec.name}"]
        rows.append(_row(f"{spec.name} SCD2 integrity", most == 1, most, F.lit(1)))
    for spec in (CLAIMANT, POLICY):
        rows.append(_none(f"{spec.name} no NULL {spec.natural_key}", n[f"no_key_{spec.name}"]))
    return per_key.agg(*[count.alias(name) for name, count in counts.items()]).select(F.inline(F.array(*rows)))


#: Reports as they are kept, run by run.
HISTORY_SCHEMA = (
    "run string, checked_on date, check_name string, result string, value bigint, expected bigint"
)


def kept(result: DataFrame, run: str, day: datetime.date) -> DataFrame:
    """A report in the form in which it is kept."""
    return result.select(F.lit(run).alias("run"), F.lit(day).alias("checked_on"), *result.columns)


def trend(history: DataFrame) -> DataFrame:
    """Every kept row beside the run before: its value, the change, and how many runs in a row have failed.

    A window per check: its rows are as many as there are runs.
    """
    by_run = Window.partitionBy("check_name").orderBy("run")
    failed = F.col("result") != "PASS"
    passes = F.sum(F.when(failed, 0).otherwise(1)).over(by_run.rowsBetween(Window.unboundedPreceding, 0))
    counted = history.withColumns({"previous_value": F.lag("value").over(by_run), "_passes": passes})
    since = Window.partitionBy("check_name", "_passes").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        *history.columns,
        "previous_value",
        (F.col("value") - F.col("previous_value")).alias("change"),
        F.sum(F.when(failed, 1).otherwise(0)).over(since).alias("failures_in_a_row"),
    )


def gate(result: DataFrame) -> list:
    """Collect the report (a dozen rows) and raise if any check failed."""
    rows = result.collect()
    failed = [r.check_name for r in rows if r.result != "PASS"]
    if failed:
        raise QualityError(f"{len(rows) - len(failed)}/{len(rows)} checks passed; failed: {', '.join(failed)}")
    return rows
