"""Calendar expressions and the day-grain date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First and last day of the two date dimensions, and the open end of a version.
WAREHOUSE_DAYS = (date(1990, 1, 1), date(2000, 12, 31))
MART_DAYS = (date(1990, 1, 1), date(2025, 12, 31))
OPEN_END = date(9999, 12, 31)


def padded_name(day: Column, pattern: str) -> Column:
    """Month or weekday name, blank-padded to nine characters."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def sunday_weekday(day: Column) -> Column:
    return F.dayofweek(day) - 1


def _days(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day. A calendar has a few ten thousand rows at most: one partition."""
    span = (last - first).days + 1
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    date_id = (F.col("id") + 1).cast("int").alias("date_id")
    return spark.range(0, span, 1, 1).select(date_id, day.alias("date"))


def _parts() -> list[Column]:
    day = F.col("date")
    return [
        F.col("date_id"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
    ]


def warehouse_calendar(spark: SparkSession, days: tuple[date, date] = WAREHOUSE_DAYS) -> DataFrame:
    """ISO weekdays 1-7, quarter names, Saturday and Sunday as weekend."""
    day = F.col("date")
    return _days(spark, *days).select(
        *_parts(),
        iso_weekday(day).alias("day_of_week"),
        padded_name(day, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
    )


def mart_calendar(spark: SparkSession, days: tuple[date, date] = MART_DAYS) -> DataFrame:
    """Weekdays 0-6 from Sunday, day names, a holiday flag that starts false."""
    day = F.col("date")
    return _days(spark, *days).select(
        *_parts(),
        sunday_weekday(day).alias("day_of_week"),
        padded_name(day, "EEEE").alias("day_name"),
        padded_name(day, "MMMM").alias("month_name"),
        sunday_weekday(day).isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def add_missing_days(existing: DataFrame, generated: DataFrame) -> DataFrame:
    """Keep stored days as they are and append the days not stored yet."""
    return existing.unionByName(generated.join(existing.select("date"), "date", "left_anti"))
