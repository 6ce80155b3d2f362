"""Calendar dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import as_date, date_key


def day_spine(bounds: DataFrame, lo: str | Column, hi: str | Column) -> DataFrame:
    """One row per day of each [lo, hi] in bounds; column date_day."""
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    step = F.expr("interval 1 day")
    return bounds.where(lo.isNotNull()).select(F.explode(F.sequence(lo, hi, step)).alias("date_day"))


def calendar_attributes(days: DataFrame) -> DataFrame:
    """ISO calendar columns (1 = Monday), plus a US day of week (1 = Sunday)."""
    d = F.col("date_day")
    iso_dow = F.weekday(d) + 1
    return days.select(
        d,
        date_key(d).alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        iso_dow.alias("day_of_week"),
        F.dayofweek(d).alias("day_of_week_us"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("iso_week"),
        (iso_dow >= 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, lo: dt.date | str, hi: dt.date | str) -> DataFrame:
    """Calendar rows for every day from lo to hi, both included."""
    bounds = spark.range(1).select(as_date(lo).alias("lo"), as_date(hi).alias("hi"))
    return calendar_attributes(day_spine(bounds, "lo", "hi"))


def dim_date_observed(df: DataFrame, ts: str) -> DataFrame:
    """Calendar rows spanning the first to the last day seen in a column."""
    bounds = df.agg(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi"))
    return calendar_attributes(day_spine(bounds, "lo", "hi"))
