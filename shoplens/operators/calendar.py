"""A calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.functions import day_of_week, month_start, quarter_start, week_start


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day of each ``[start_date, end_date)``."""
    days = F.explode(F.sequence("start_date", "end_date")).alias("date_day")
    # the last day is generated and dropped: an empty range has no sequence without it
    span = bounds.filter(F.col("start_date") < F.col("end_date"))
    day = F.col("date_day")
    return (
        span.select("end_date", days)
        .filter(day < F.col("end_date"))
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.day(day).alias("day"),
            F.quarter(day).alias("quarter"),
            day_of_week(day).alias("day_of_week"),
            F.dayname(day).alias("day_name"),
            F.monthname(day).alias("month_name"),
            week_start(day).alias("week_start_date"),
            month_start(day).alias("month_start_date"),
            quarter_start(day).alias("quarter_start_date"),
            day_of_week(day).isin(0, 6).alias("is_weekend"),
        )
    )


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` up to, but without, ``end``."""
    bounds = spark.range(1).select(
        F.lit(start).alias("start_date"), F.lit(end).alias("end_date")
    )
    return calendar_between(bounds)
