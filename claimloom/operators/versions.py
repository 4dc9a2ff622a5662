"""Newest-version logic that stays parallel when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators.keys import where_landed
from claimloom.sources.paths import land, work_folder


def newest_first(df: DataFrame, column: str, key: str) -> list[Column]:
    """A total order: newest ``column`` first (NULL last), ties settled by content."""
    rest = [c for c in df.columns if c not in (column, key)]
    return [F.col(column).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]


def newest_by_hash(df: DataFrame, column: str, key: str) -> list[Column]:
    """As ``newest_first``, ties settled by a hash of the content: what is ranked stays narrow."""
    rest = [c for c in df.columns if c not in (column, key)]
    return [F.col(column).desc_nulls_last(), F.xxhash64(*rest).asc()]


def flag_newest(
    df: DataFrame, key: str, order: list[Column], flag: str = "is_current", landing: str | None = None
) -> DataFrame:
    """Mark exactly one row per key, the first in ``order``; keep every row.

    One plan for all sizes: the rows land, so the input is read once and every row has an
    identity; the newest of each key is found as in ``keep_newest``, each map task sending
    one row per key; and the flag comes back by identity, which is even however many rows
    a key has.  Only key, identity and what ``order`` names are shuffled to be ranked.  Of
    rows equal in ``order`` the one that landed first is marked.
    """
    landed = land(df, landing or work_folder(df.sparkSession, f"versions-{key}"))
    placed = where_landed(landed)
    identity = ["_task", "_file", "_position"]
    newest = keep_newest(placed, key, [*order, *[F.col(c).asc() for c in identity]])
    flags = newest.select(*identity, F.lit(True).alias("_newest"))
    flagged = placed.join(flags, identity, "left")
    return flagged.select(*df.columns, F.coalesce("_newest", F.lit(False)).alias(flag))


def keep_newest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle:
    each map task sends one row per key, so a hot key never meets in one task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
