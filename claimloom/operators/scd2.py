"""Slowly changing dimensions, type 2: one pass instead of UPDATE + INSERT + INSERT."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.operators.keys import number_rows
from claimloom.schemas import Dimension
from claimloom.sources.paths import land, work_folder


def staged_bounds(staged: DataFrame, spec: Dimension) -> DataFrame:
    """One row per staged key: least and greatest value of each tracked attribute."""
    return staged.groupBy(spec.natural_key).agg(
        *[F.min(c).alias(f"_min_{c}") for c in spec.tracked],
        *[F.max(c).alias(f"_max_{c}") for c in spec.tracked],
    )


def judge_open(dim: DataFrame, bounds: DataFrame, spec: Dimension) -> DataFrame:
    """The open rows of staged keys, with ``_expires`` saying whether this load closes them.

    A row closes when any staged version of its key, newest or not, differs in a
    tracked attribute.  NULL on either side is no difference.  Some staged value
    differs from v exactly if their minimum or their maximum does, so one row of
    ``staged_bounds`` per key is all that is joined.
    """
    differs = [F.col(f"_{side}_{c}") != F.col(c) for c in spec.tracked for side in ("min", "max")]
    expires = F.coalesce(reduce(or_, [F.coalesce(d, F.lit(False)) for d in differs]), F.lit(False))
    open_rows = dim.filter(F.col("is_current"))
    return open_rows.join(bounds, spec.natural_key).select(*dim.columns, expires.alias("_expires"))


def closed_on(judged: DataFrame, as_of: datetime.date) -> DataFrame:
    """Judged rows as they stand after the load: expiring ones end the day before."""
    day_before = F.lit(as_of - datetime.timedelta(days=1))
    return judged.withColumns(
        {
            "effective_to": F.when(F.col("_expires"), day_before).otherwise(F.col("effective_to")),
            "is_current": ~F.col("_expires"),
        }
    ).drop("_expires")


def _arrivals(dim: DataFrame, judged: DataFrame, bounds: DataFrame, staged: DataFrame, spec: Dimension) -> DataFrame:
    """Newest staged versions, with ``_open``: NULL = key never seen, FALSE = no open row left.

    Of the history only rows of staged keys go on to be grouped.
    """
    key = spec.natural_key
    history = dim.filter(~F.col("is_current")).join(bounds.select(key), key, "left_semi")
    history = history.select(key, F.lit(False).alias("_open"))
    still_open = judged.select(key, (~F.col("_expires")).alias("_open"))
    state = history.unionByName(still_open).groupBy(key).agg(F.max("_open").alias("_open"))
    return staged.filter(F.col("is_current")).join(state, key, "left")


def _as_versions(rows: DataFrame, spec: Dimension, effective_from: Column) -> DataFrame:
    types = {f.name: f.dataType for f in spec.schema.fields}
    added = [f.name for f in spec.added]
    return rows.select(
        *[F.col(c).cast(types[c]).alias(c) for c in spec.attributes if c not in added],
        effective_from.alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        *[F.col(c).try_cast(types[c]).alias(c) for c in added],
    )


def new_versions(arrivals: DataFrame, spec: Dimension, as_of: datetime.date) -> DataFrame:
    """Keys the dimension has never held: valid from their staged date."""
    rows = arrivals.filter(F.col("_open").isNull())
    return _as_versions(rows, spec, F.coalesce(F.col("effective_from"), F.lit(as_of)))


def changed_versions(arrivals: DataFrame, spec: Dimension, as_of: datetime.date) -> DataFrame:
    """Known keys without an open row left: valid from the day of the load."""
    return _as_versions(arrivals.filter(~F.col("_open")), spec, F.lit(as_of))


def merge_steps(dim: DataFrame, staged: DataFrame, spec: Dimension, as_of: datetime.date) -> dict[str, DataFrame]:
    """The three effects of a load, one DataFrame each: expired, new and changed."""
    bounds = staged_bounds(staged, spec)
    judged = judge_open(dim, bounds, spec)
    arrivals = _arrivals(dim, judged, bounds, staged, spec)
    return {
        "expired": closed_on(judged.filter(F.col("_expires")), as_of),
        "new": new_versions(arrivals, spec, as_of),
        "changed": changed_versions(arrivals, spec, as_of),
    }


def load_changes(
    dim: DataFrame | None,
    staged: DataFrame,
    spec: Dimension,
    as_of: datetime.date,
    landing: str | None = None,
    last_key: int | None = None,
) -> DataFrame:
    """Every row the load writes: open rows, kept or just closed, and inserted versions.

    Earlier history is not part of it; it never changes in a load.  ``dim`` is None
    before the first load.  ``last_key`` is the greatest surrogate key given so far;
    without it the dimension is searched for it.

    Which rows close and which keys get a version is worked out on keys and tracked
    attributes alone, for the delivered keys alone.  All of that is landed, one row per
    delivered key or fewer: Spark knows its size and broadcasts it if it is small; the
    dimension is then read but not shuffled, and what is grouped or sorted is as large
    as the delivery, not as the history.
    """
    landing = landing or work_folder(staged.sparkSession, spec.name)
    key, row = spec.natural_key, spec.surrogate_key
    heads = staged.filter(F.col("is_current"))
    if dim is None:
        first = new_versions(heads.withColumn("_open", F.lit(None).cast("boolean")), spec, as_of)
        return number_rows(first, row, 0, [key], f"{landing}/inserted")

    bounds = land(staged_bounds(staged, spec), f"{landing}/bounds")
    narrow = dim.select(row, key, *spec.tracked, "is_current")
    verdicts = land(judge_open(narrow, bounds, spec).select(row, key, "_expires"), f"{landing}/verdicts")
    expiring = land(verdicts.filter("_expires").select(row), f"{landing}/expiring")
    open_rows = dim.filter(F.col("is_current"))
    kept = open_rows.join(expiring, row, "left_anti")
    closed = closed_on(open_rows.join(expiring, row).withColumn("_expires", F.lit(True)), as_of)
    # The few rows that close are gathered in few files; the open ones stay where they are.
    closed = closed.select(*dim.columns).hint("rebalance")

    keys = heads.select(key, F.lit(True).alias("is_current")).distinct()
    arrivals = _arrivals(dim, verdicts, bounds, keys, spec)
    wanted = land(arrivals.filter(F.col("_open").isNull() | ~F.col("_open")).select(key, "_open"), f"{landing}/wanted")
    unseen = F.col("_open").isNull()
    since = F.when(unseen, F.coalesce(F.col("effective_from"), F.lit(as_of))).otherwise(F.lit(as_of))
    inserted = _as_versions(heads.join(wanted, key), spec, since)
    if last_key is None:
        last_key = dim.agg(F.max(row)).first()[0] or 0
    keyed = number_rows(inserted, row, last_key, [key], f"{landing}/inserted")
    return kept.unionByName(closed).unionByName(keyed)


def merge(
    dim: DataFrame | None,
    staged: DataFrame,
    spec: Dimension,
    as_of: datetime.date,
    landing: str | None = None,
) -> DataFrame:
    """The whole dimension after the load."""
    changes = load_changes(dim, staged, spec, as_of, landing)
    return changes if dim is None else dim.filter(~F.col("is_current")).unionByName(changes)
