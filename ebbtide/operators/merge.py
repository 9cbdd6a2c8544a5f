"""Positions laid over the full list of codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEASURES = ("shorts", "total", "percent")


def _columns(measures: Sequence[str]) -> list[str]:
    return ["date", "code", "name", *measures, "industry"]


def merge_day(codes: DataFrame, positions: DataFrame, date: Column | int) -> DataFrame:
    """Every code on the one day ``date``, zero where it has no position.

    Both sides are unique on ``code``, ``positions`` holds that day only, and the
    day has a report: without one there is nothing to merge.
    """
    return (
        codes.select("code", "name", "industry")
        .join(positions.select("code", *MEASURES), "code", "left")
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in MEASURES})
        .withColumn("date", F.lit(date).cast("int"))
        .select(_columns(MEASURES))
    )


def merge_days(
    codes: DataFrame,
    positions: DataFrame,
    days: DataFrame,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Every code on every day of ``days``, its ``measures`` zero without a position.

    ``codes`` is unique on ``code``, ``positions`` on ``(code, date)`` and within
    ``days``; positions of unknown codes drop out. The join is one per code, not one
    per code and day: each code meets an array of its positions (at most one per
    calendar day), and the days missing from it are filled in while the array is
    unnested, so names and zeros are never shuffled.

    A code becomes a row per day only after the join, which adaptive execution
    cannot foresee from the join's input: codes therefore keep the session's number
    of shuffle partitions, where it would merge them into few tasks.
    """
    tasks = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    point = T.StructType(
        [T.StructField("date", T.IntegerType())]
        + [T.StructField(name, positions.schema[name].dataType) for name in measures]
    )
    series = positions.groupBy("code").agg(
        F.collect_list(F.struct("date", *measures).cast(point)).alias("points")
    )
    all_days = days.select(F.col("date").cast("int")).distinct().agg(F.collect_list("date"))

    def zero(day):
        zeros = [F.lit(0).cast(point[name].dataType).alias(name) for name in measures]
        return F.struct(day.alias("date"), *zeros).cast(point)

    known = F.coalesce(F.col("points"), F.array().cast(T.ArrayType(point)))
    missing = F.array_except(F.col("all_days"), F.transform(known, lambda p: p["date"]))
    return (
        codes.select("code", "name", "industry")
        .repartition(tasks, "code")
        .join(series, "code", "left")
        .withColumn("all_days", all_days.scalar())
        .select(
            "code",
            "name",
            "industry",
            F.inline(F.concat(known, F.transform(missing, zero))),
        )
        .select(_columns(measures))
    )
