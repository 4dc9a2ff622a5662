"""Column clean-up shared by all entities: trim, typed casts, missing columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trimmed(field: T.StructField) -> Column:
    """A text column without blanks (U+0020) around it; any other column as it is."""
    return F.trim(field.name) if isinstance(field.dataType, T.StringType) else F.col(field.name)


def try_convert(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields NULL for text that does not parse, whatever the ANSI setting."""
    if source == target:
        return column
    if isinstance(target, T.LongType) and isinstance(source, T.StringType):
        # Integer columns holding blanks are often exported as 12.0; keep those as 12.
        return F.coalesce(column.try_cast("bigint"), column.try_cast("decimal(38,18)").try_cast("bigint"))
    return column.try_cast(target)


def conform(df: DataFrame, schema: T.StructType, **derived: Column) -> DataFrame:
    """Clean a delivery in one projection.

    Text is trimmed, columns named in ``schema`` get their type, those the delivery
    lacks are added as NULL, columns nobody asked for flow on.  ``derived`` replaces
    a column by, or adds, an expression over the delivered ones.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    present = [
        try_convert(trimmed(f), f.dataType, wanted.get(f.name, f.dataType)).alias(f.name)
        for f in df.schema.fields
        if f.name not in derived
    ]
    absent = [
        F.lit(None).cast(kind).alias(name)
        for name, kind in wanted.items()
        if name not in df.columns and name not in derived
    ]
    return df.select(*present, *absent, *[column.alias(name) for name, column in derived.items()])


def date_key(column: Column) -> Column:
    """yyyymmdd as INTEGER; NULL stays NULL."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)
