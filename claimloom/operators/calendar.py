"""The date dimension."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions.cleaning import date_key

# The first and last day of the calendar.
FIRST_DAY = datetime.date(2020, 1, 1)
LAST_DAY = datetime.date(2030, 12, 31)


def dim_date(
    spark: SparkSession, first: datetime.date = FIRST_DAY, last: datetime.date = LAST_DAY
) -> DataFrame:
    """One row per day.  day_of_week counts from 0 = Sunday; names are not padded."""
    days = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day")))
    day = F.col("full_date")
    day_of_week = F.dayofweek(day) - 1
    return spark.range(1).select(days.alias("full_date")).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        day_of_week.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        day_of_week.isin(0, 6).alias("is_weekend"),
        (day == F.last_day(day)).alias("is_month_end"),
    )
