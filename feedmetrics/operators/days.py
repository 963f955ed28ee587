"""The day a row belongs to, and the prefix all daily metrics share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmetrics.functions.text import blank_to_null
from feedmetrics.functions.times import date_part_columns


def row_date(df: DataFrame) -> Column:
    """data_date, else the year-month-day parts, else the creation timestamp.

    Columns the table lacks are skipped.
    """
    present = set(df.columns)
    choices = []
    if "data_date" in present:
        choices.append(blank_to_null(F.col("data_date")))
    if {"year", "month", "day"} <= present:
        # concat is null as soon as one part is null
        choices.append(F.concat(blank_to_null(F.col("year")), F.lit("-"),
                                blank_to_null(F.col("month")), F.lit("-"),
                                blank_to_null(F.col("day"))))
    if "created_at_utc" in present:
        created = F.col("created_at_utc")
        choices.append(F.when(F.length(created) >= 10, F.substring(created, 1, 10)))
    return F.coalesce(*choices)


def on_day(df: DataFrame, day: str | None) -> DataFrame:
    """Rows of one day; all rows without a day.

    The first predicate is implied by the second. It is there because it is
    plain enough to reach the Parquet scan, where it skips row groups.
    """
    if not day:
        return df
    data_date = F.col("data_date")
    return (df.where((data_date == day) | data_date.isNull() | (data_date == ""))
            .where(row_date(df) == day))


def of_platform(df: DataFrame, platform: str) -> DataFrame:
    return df.where(F.col("platform") == platform)


def dated(df: DataFrame, platform: str) -> DataFrame:
    """Rows of the platform that belong to a day, with that day as ``date``."""
    day = row_date(df)
    return of_platform(df, platform).withColumn("date", day).where(F.col("date") != "")


def metric_columns(platform: str, processed_at: str) -> list[Column]:
    """date, platform, year, month, day, gold_processed_at_utc."""
    parts = date_part_columns(F.col("date"))
    return [F.col("date"), F.lit(platform).alias("platform"),
            *(column.alias(name) for name, column in parts.items()),
            F.lit(processed_at).alias("gold_processed_at_utc")]
