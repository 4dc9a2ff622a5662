"""Schema evolution: compare the columns of a delivery with those seen before."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Events and registry entries are schema-sized: one row per entity.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType(), False),
        T.StructField("detection_date", T.DateType(), False),
        T.StructField("previous_version", T.StringType()),
        T.StructField("current_version", T.StringType()),
        T.StructField("previous_columns", T.StringType()),
        T.StructField("current_columns", T.StringType()),
        T.StructField("added_columns", T.StringType()),
        T.StructField("removed_columns", T.StringType()),
    ]
)
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType(), False),
        T.StructField("columns", T.ArrayType(T.StringType()), False),
        T.StructField("as_of", T.StringType(), False),
    ]
)


def delivered_columns(spark: SparkSession, columns: dict[str, list[str]], ingestion_date: datetime.date) -> DataFrame:
    """The columns of each delivered entity, in the form of the registry."""
    rows = [(entity, names, ingestion_date.isoformat()) for entity, names in columns.items()]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


#: What the runs have delivered, appended to run by run; the ids of runs rise.
SNAPSHOT_SCHEMA = T.StructType([*REGISTRY_SCHEMA.fields, T.StructField("run", T.StringType(), False)])


def columns_as_of(snapshots: DataFrame, day: datetime.date) -> DataFrame:
    """entity, columns, as_of: what each entity looked like on a day, one row per entity that had come by then.

    Of several deliveries of one date the one that ran last counts.
    """
    known = snapshots.filter(F.col("as_of") <= day.isoformat())
    last = F.max_by(F.struct("columns", "as_of"), F.struct("as_of", "run")).alias("last")
    return known.groupBy("entity").agg(last).select("entity", "last.*")


def snapshot_per_day(snapshots: DataFrame) -> DataFrame:
    """entity, as_of, columns: one row per entity and date of a delivery."""
    last = F.max_by("columns", "run").alias("columns")
    return snapshots.groupBy("entity", "as_of").agg(last)


def registry_after(registry: DataFrame, delivered: DataFrame) -> DataFrame:
    """The registry as of this delivery: entities that did not come stay as they were."""
    return registry.join(delivered, "entity", "left_anti").unionByName(delivered)


def _json_list(names: Column) -> Column:
    """A list as JSON text, with a blank after each comma."""
    quoted = F.transform(names, lambda name: F.regexp_extract(F.to_json(F.array(name)), r"^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def changes(registry: DataFrame, delivered: DataFrame) -> DataFrame:
    """An event for each entity whose columns are not those the registry has.

    Only names count: a rename is one column removed and one added, a new type or a new
    order is no event, nor is a first delivery.
    """
    before, now = registry.alias("before"), delivered.alias("now")
    met = now.join(before, "entity").select(
        "entity",
        F.col("before.as_of").alias("previous_version"),
        F.col("now.as_of").alias("current_version"),
        F.col("before.columns").alias("previous"),
        F.col("now.columns").alias("current"),
        F.array_except("now.columns", "before.columns").alias("added"),
        F.array_except("before.columns", "now.columns").alias("removed"),
    )
    lists = [_json_list(F.col(c)).alias(f"{c}_columns") for c in ("previous", "current", "added", "removed")]
    day = F.to_date("current_version").alias("detection_date")
    changed = met.filter((F.size("added") > 0) | (F.size("removed") > 0))
    return changed.select("entity", day, "previous_version", "current_version", *lists)


def log_entries(events: DataFrame, last_log_id: int) -> DataFrame:
    """Events with their log_id.  A load has at most one event per entity."""
    ordered = events.orderBy("entity").coalesce(1)
    return ordered.select((F.monotonically_increasing_id() + last_log_id + 1).alias("log_id"), *events.columns)


def history_view(log: DataFrame) -> DataFrame:
    """What readers of the log see, newest first."""
    return log.select(
        "entity", "detection_date", "previous_version", "current_version", "added_columns", "removed_columns"
    ).orderBy(F.col("detection_date").desc(), "entity")
