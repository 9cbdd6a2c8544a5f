"""The table of codes by short percentage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.rank import all_ranked, first_ranked


def _by_percent():
    return [F.desc("percent"), F.asc("code")]


def _ranked_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("position").alias("Position"),
        F.col("code").alias("Code"),
        F.col("percent").alias("Percent"),
    )


def ranked_codes(day: DataFrame) -> DataFrame:
    """Every code of a normalised day by falling percentage, places from 0."""
    rows = day.select("code", "percent")
    return _ranked_columns(all_ranked(rows, _by_percent(), "position"))


def leading_codes(day: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of :func:`ranked_codes` without ranking the rest."""
    rows = day.select("code", "percent")
    return _ranked_columns(first_ranked(rows, _by_percent(), count, "position"))


def series_rows(day: DataFrame) -> DataFrame:
    """A normalised day as rows of the time-series table."""
    return day.select(
        F.col("name").alias("Name"),
        F.col("code").alias("Code"),
        F.col("shorts").alias("Shorts"),
        F.col("total").alias("Total"),
        F.col("percent").alias("Percent"),
        F.col("industry").alias("Industry"),
        F.col("date").alias("Date"),
    )
