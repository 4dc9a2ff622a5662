"""Finding and fixing faults in the history of an SCD2 dimension."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.versions import flag_newest
from claimloom.schemas import Dimension
from claimloom.sources.paths import land, work_folder

# Width of the day bins that bring overlapping versions together.
BIN_DAYS = 64
OPEN_END = datetime.date(9999, 12, 31)


def duplicate_current(dim: DataFrame, spec: Dimension) -> DataFrame:
    """Natural keys with more than one open row."""
    return (
        dim.filter(F.col("is_current"))
        .groupBy(spec.natural_key)
        .agg(F.count(F.lit(1)).alias("current_count"))
        .filter(F.col("current_count") > 1)
    )


def version_history(dim: DataFrame, spec: Dimension, where: Column, newest_first: bool = False) -> DataFrame:
    """The versions picked by ``where`` (a natural or surrogate key), in order of validity."""
    start = F.col("effective_from")
    return (
        dim.filter(where)
        .select(spec.surrogate_key, spec.natural_key, "effective_from", "effective_to", "is_current")
        .orderBy(spec.natural_key, start.desc() if newest_first else start.asc(), spec.surrogate_key)
    )


def history_gaps(dim: DataFrame, spec: Dimension) -> DataFrame:
    """Periods between versions that no version covers, for every key at once.

    Versions are first reduced to one row per key and start day, so the window sees
    at most one row per calendar day however many versions a key has.
    """
    key = spec.natural_key
    last_day = F.coalesce(F.col("effective_to"), F.lit(OPEN_END))
    starts = dim.groupBy(key, "effective_from").agg(F.max(last_day).alias("_until"))
    in_order = Window.partitionBy(key).orderBy("effective_from")
    covered = F.max("_until").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A version ending before it starts covers nothing, but still marks its own start.
    covered_to = F.greatest(covered, F.date_sub("effective_from", 1))
    return (
        starts.withColumns({"_covered": covered_to, "_next": F.lead("effective_from").over(in_order)})
        .filter(F.col("_next") > F.date_add("_covered", 1))
        .select(
            key,
            F.date_add("_covered", 1).alias("gap_from"),
            F.date_sub("_next", 1).alias("gap_to"),
            (F.datediff("_next", "_covered") - 1).cast("bigint").alias("gap_days"),
        )
    )


def overlaps(dim: DataFrame, spec: Dimension, bin_days: int = BIN_DAYS, landing: str | None = None) -> DataFrame:
    """Pairs of closed versions of one key whose validity overlaps, each pair in both orders.

    Condition on a pair: a.from < b.to and a.to > b.from; open rows never match.  Of
    the two, the one that starts later starts inside the other.  So only days on which a
    version starts while an earlier one still runs, or several start, can have pairs:
    they are found on one row per key and start day, and an orderly key is never binned.
    These days land in ``landing``, a new work folder if it is not given: Spark knows how
    many there are, and a join of all versions of a hot key with them can be split.

    A row starting on such a day is looked up by the bin of its start among the bins the
    others cover.  Rows far apart in time never meet, and a key with many versions is
    spread over its bins.  Bins end with the last such day of the key, so a far end
    (9999-12-31) adds none beyond it.
    """
    key, row = spec.natural_key, spec.surrogate_key

    def bin_of(day: Column) -> Column:
        return F.floor(F.datediff(day, F.lit(datetime.date(1970, 1, 1))) / bin_days)

    start, end = F.col("effective_from"), F.col("effective_to")
    closed = dim.filter(end.isNotNull()).select(key, row, "effective_from", "effective_to")
    days = closed.groupBy(key, "effective_from").agg(F.max(end).alias("_until"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("effective_from").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_reach", F.max("_until").over(earlier))
    crowded = days.filter((F.col("_reach") > start) | (F.col("_n") > 1)).select(key, "effective_from")
    landing = landing or work_folder(dim.sparkSession, "overlaps")
    crowded = land(crowded, f"{landing}/days")
    until = land(crowded.groupBy(key).agg(F.max("effective_from").alias("_until")), f"{landing}/keys")
    reaching = closed.filter(start < end).join(until, key).filter(start <= F.col("_until"))
    covering = reaching.select(
        key,
        F.col(row).alias("_row"),
        start.alias("_from"),
        end.alias("_to"),
        F.explode(F.sequence(bin_of(start), bin_of(F.least(end, F.col("_until"))))).alias("_bin"),
    )
    later = closed.join(crowded, [key, "effective_from"], "left_semi").withColumn("_bin", bin_of(start))
    met = later.join(covering, [key, "_bin"]).filter(
        (F.col(row) != F.col("_row"))
        & (start >= F.col("_from"))
        & (start < F.col("_to"))
        & (end > F.col("_from"))
    )

    def pair(a: tuple[str, str, str], b: tuple[str, str, str]) -> Column:
        names = ("key", "effective_from", "effective_to")
        return F.struct(
            *[F.col(c).alias(f"a_{n}") for c, n in zip(a, names)],
            *[F.col(c).alias(f"b_{n}") for c, n in zip(b, names)],
        )

    one = (row, "effective_from", "effective_to")
    other = ("_row", "_from", "_to")
    # Rows starting on the same day find each other from both sides already.
    both_orders = F.when(start > F.col("_from"), F.array(pair(one, other), pair(other, one))).otherwise(
        F.array(pair(one, other))
    )
    return met.select(key, F.explode(both_orders).alias("_pair")).select(key, "_pair.*")


def close_versions(dim: DataFrame, where: Column, effective_to: datetime.date) -> DataFrame:
    """Close the rows picked by ``where`` (by surrogate key, or open rows of a natural key)."""
    hit = F.coalesce(where, F.lit(False))
    return dim.withColumns(
        {
            "effective_to": F.when(hit, F.lit(effective_to)).otherwise(F.col("effective_to")),
            "is_current": F.when(hit, F.lit(False)).otherwise(F.col("is_current")),
        }
    )


def correct_versions(dim: DataFrame, where: Column, column: str, value: Column) -> DataFrame:
    """Overwrite one attribute in the rows picked by ``where``."""
    hit = F.coalesce(where, F.lit(False))
    return dim.withColumn(column, F.when(hit, value.cast(dim.schema[column].dataType)).otherwise(F.col(column)))


def keep_latest_current(
    dim: DataFrame, spec: Dimension, effective_to: datetime.date, landing: str | None = None
) -> DataFrame:
    """Where a key has several open rows, keep the one that starts last; close the others."""
    order = [F.col("effective_from").desc(), F.col(spec.surrogate_key).desc()]
    open_rows = dim.filter(F.col("is_current"))
    flagged = flag_newest(open_rows, spec.natural_key, order, "_stays", landing)
    repaired = close_versions(flagged, ~F.col("_stays"), effective_to).drop("_stays")
    return dim.filter(~F.col("is_current")).unionByName(repaired)
