"""Staging: landed Parquet under its declared schema, checked before it is merged.

Staging tables hold exactly what has landed, so they are a checked projection of the
landing files, not a second copy of them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LoadError(Exception):
    """Landed rows do not fit their table."""


def faults(schema: T.StructType) -> Column:
    """Array of what is wrong with a row: required columns that are NULL, text too long."""
    checks = []
    for field in schema.fields:
        column = F.col(field.name)
        if not field.nullable:
            checks.append(F.when(column.isNull(), F.lit(f"{field.name} is NULL")))
        limit = field.metadata.get("max_length")
        if limit:
            checks.append(F.when(F.char_length(column) > limit, F.lit(f"{field.name} is longer than {limit}")))
    return F.array_compact(F.array(*checks))


def is_faulty(schema: T.StructType) -> Column:
    """Whether a row has any fault; cheaper than listing them."""
    tests = [F.col(f.name).isNull() for f in schema.fields if not f.nullable]
    tests += [
        F.coalesce(F.char_length(F.col(f.name)) > f.metadata["max_length"], F.lit(False))
        for f in schema.fields
        if "max_length" in f.metadata
    ]
    return reduce(or_, tests)


def staged(landed: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed rows as the staging table has them: by name, whatever else has landed.

    A required column must be there; another one that did not land is NULL.  In a column that
    was added, text that does not parse as its type is NULL.
    """
    absent = [f.name for f in schema.fields if not f.nullable and f.name not in landed.columns]
    if absent:
        raise LoadError(f"landed files lack {', '.join(absent)}")

    def typed(field: T.StructField) -> Column:
        column = F.col(field.name) if field.name in landed.columns else F.lit(None)
        return column.try_cast(field.dataType) if field.metadata.get("added") else column.cast(field.dataType)

    return landed.select(*[typed(f).alias(f.name) for f in schema.fields])


def unfit(stored: T.StructType, declared: T.StructType) -> list[str]:
    """What keeps files of one schema from being read under another, by their footers: columns gone or of other types."""
    kinds = {f.name: f.dataType for f in stored}
    found = [f"{f.name} is not there" for f in declared if f.name not in kinds]
    return found + [
        f"{f.name} is {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}"
        for f in declared
        if f.name in kinds and kinds[f.name] != f.dataType
    ]


def rejects(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that do not fit, with their faults."""
    return rows.withColumn("faults", faults(schema)).filter(F.size("faults") > 0)


def newest_rejects(rows: DataFrame, schema: T.StructType, newest_by: str, count: int = 10) -> DataFrame:
    """The report to look at after a failed load: the newest rejected rows."""
    key = schema.fields[0].name
    return rejects(rows, schema).orderBy(F.col(newest_by).desc_nulls_last(), key).limit(count)
