"""Calendar dimension: weekends and public holidays by rule, one row per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitline import schemas

# Holidays. Month, then either a day of the month or a weekday
# (Monday 0) and the days of the month its wanted occurrence can fall on.
FIXED_HOLIDAYS = (
    ("Independence Day", 7, 4),
    ("Christmas Day", 12, 25),
)
FLOATING_HOLIDAYS = (
    ("Labor Day", 9, 0, (1, 7)),
    ("Thanksgiving", 11, 3, (22, 28)),
)


def _holiday_name(day: Column, strictly_after_first: bool) -> Column:
    """Name of the holiday on a day, else NULL.

    ``strictly_after_first`` counts weekdays from the 2nd of the month on, which
    moves a holiday by a week where the month begins on that weekday.
    """
    shift = 1 if strictly_after_first else 0
    month, of_month, weekday = F.month(day), F.dayofmonth(day), F.weekday(day)
    matches = [
        F.when((month == m) & (of_month == d), F.lit(name)) for name, m, d in FIXED_HOLIDAYS
    ] + [
        F.when(
            (month == m) & (weekday == w) & of_month.between(low + shift, high + shift),
            F.lit(name),
        )
        for name, m, w, (low, high) in FLOATING_HOLIDAYS
    ]
    return F.coalesce(*matches)


def calendar_of_days(days: DataFrame, strictly_after_first: bool = False) -> DataFrame:
    """Calendar columns for a DataFrame holding one ``cal_date`` per day."""
    day = F.col("cal_date")
    calendar = days.select(
        day,
        F.weekday(day).cast("smallint").alias("dow"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        _holiday_name(day, strictly_after_first).alias("holiday_name"),
    ).withColumn("is_holiday", F.col("holiday_name").isNotNull())
    return calendar.select(*schemas.CALENDAR.fieldNames())


def calendar(
    spark: SparkSession, start: dt.date, days: int, strictly_after_first: bool = False
) -> DataFrame:
    """Calendar of ``days`` days from ``start`` on."""
    every_day = spark.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("cal_date")
    )
    return calendar_of_days(every_day, strictly_after_first)


def calendar_around(
    dates: DataFrame, column: str, strictly_after_first: bool = False
) -> DataFrame:
    """Calendar of all whole years that the dates of a column touch."""
    years = dates.agg(
        F.trunc(F.min(F.col(column).cast("date")), "year").alias("first_day"),
        F.date_sub(
            F.add_months(F.trunc(F.max(F.col(column).cast("date")), "year"), 12), 1
        ).alias("last_day"),
    )
    every_day = years.select(F.explode(F.sequence("first_day", "last_day")).alias("cal_date"))
    return calendar_of_days(every_day, strictly_after_first)
