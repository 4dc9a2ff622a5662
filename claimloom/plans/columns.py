"""Columns that users have added to tables or dropped from them, noted beside the warehouse.

The declared schemas are code; this log is what has been decided since.  The last entry
on a column counts, so a dropped column can be added again.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.schemas import Dimension
from claimloom.sources.paths import Folder

_SCHEMA = "number bigint, `table` string, `column` string, `type` string, dropped boolean, tracked boolean"


class ColumnLog:
    """Tables are named as they are published, e.g. ``warehouse.dim_claimant``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/column_log"

    def _rows(self) -> DataFrame:
        if not Folder(self.spark, self.path).children():
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.path)

    def _note(self, table: str, column: str, kind: str | None, dropped: bool, tracked: bool) -> None:
        number = (self._rows().agg(F.max("number")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(number, table, column, kind, dropped, tracked)], _SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def add(self, table: str, column: str, kind: str, tracked: bool = False) -> None:
        self._note(table, column, kind, False, tracked)

    def drop(self, table: str, column: str) -> None:
        self._note(table, column, None, True, False)

    def _last(self) -> list:
        """The last entry on each column, in the order the columns were added: decisions of users, so few."""
        last = F.max_by(F.struct("type", "dropped", "tracked"), "number").alias("last")
        found = self._rows().groupBy("table", "column").agg(last, F.max("number").alias("number"))
        return found.select("table", "column", "number", "last.*").orderBy("number").collect()

    def added(self) -> dict[str, list[tuple[str, str]]]:
        """Columns to show beside the declared ones, with their types, by table."""
        found: dict[str, list[tuple[str, str]]] = {}
        for r in self._last():
            if not r.dropped:
                found.setdefault(r.table, []).append((r.column, r.type))
        return found

    def dropped(self) -> dict[str, set[str]]:
        """Columns not to show any more, in lower case, by table."""
        found: dict[str, set[str]] = {}
        for r in self._last():
            if r.dropped:
                found.setdefault(r.table, set()).add(r.column.lower())
        return found

    def widened(self, spec: Dimension) -> Dimension:
        """The dimension with the attributes added to it: taken over from the next load on."""
        own = [r for r in self._last() if r.table == f"warehouse.{spec.name}" and not r.dropped]
        known = set(spec.schema.fieldNames())
        more = [r for r in own if r.column not in known]
        fields = tuple(T.StructField(r.column, _parsed(self.spark, r.type), True, {"added": True}) for r in more)
        return replace(spec, added=fields, tracked=(*spec.tracked, *[r.column for r in more if r.tracked]))


def _parsed(spark: SparkSession, kind: str) -> T.DataType:
    return spark.createDataFrame([], f"c {kind}").schema[0].dataType
