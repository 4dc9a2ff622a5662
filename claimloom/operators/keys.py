"""Surrogate keys: dense, unique, and a pure function of the rows they number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.sources.paths import land, work_folder


def where_landed(landed: DataFrame) -> DataFrame:
    """Landed rows with their identity: the write task, its file, and the place in the file."""
    name = F.col("_metadata.file_name")
    return landed.select(
        "*",
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("_task"),
        F.regexp_extract(name, r"-c(\d+)\.", 1).cast("int").alias("_file"),
        F.col("_metadata.row_index").alias("_position"),
    )


def number_rows(
    df: DataFrame,
    key: str,
    start_after: int = 0,
    order_by: list[str] | None = None,
    landing: str | None = None,
) -> DataFrame:
    """Add ``key`` = start_after + 1, 2, 3 ... as first column.

    The rows are written and then numbered by where they landed: rows in earlier
    files + position in the file.  Only the per-file counts (one row per file) are
    summed up globally, so neither a hot key nor a group of copies ends in one task,
    and a lost executor cannot change a number that was already given.

    Without ``order_by`` the rows land as they come, with no shuffle.  With it the
    landed rows are range partitioned, sorted and landed again, so that the key equals
    ROW_NUMBER() OVER (ORDER BY order_by).  Range partitioning reads its input twice,
    once for a sample; that is why it reads landed rows, not the plan behind them.
    The source partition is its last column: it splits equal keys over several tasks.
    """
    landing = landing or work_folder(df.sparkSession, key)
    landed = land(df, f"{landing}/rows")
    if order_by:
        ranged = landed.withColumn("_source", F.spark_partition_id()).repartitionByRange(*order_by, "_source")
        landed = land(ranged.sortWithinPartitions(*order_by).drop("_source"), f"{landing}/ordered")

    files = ["_task", "_file"]
    placed = where_landed(landed)
    counts = placed.groupBy(*files).agg(F.count(F.lit(1)).alias("_rows"))
    earlier_files = Window.orderBy(*files).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*files, F.coalesce(F.sum("_rows").over(earlier_files), F.lit(0)).alias("_before"))
    # Landed, so that Spark knows its size and broadcasts it if that is small.
    offsets = land(offsets, f"{landing}/offsets")
    number = F.lit(start_after + 1).cast("bigint") + F.col("_before") + F.col("_position")
    return placed.join(offsets, files).select(number.alias(key), *df.columns)
