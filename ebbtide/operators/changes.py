"""Changes of a code's percentage between fixed days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.dates import Day, anchor_numbers
from ebbtide.functions.numbers import widened

HORIZONS = ("day", "week", "month", "year")


def changes(snapshots: DataFrame, as_of: Day) -> DataFrame:
    """Per code of the latest day: latest minus each baseline, NULL without one.

    ``snapshots`` is unique on ``(code, date)``. One pass over the five days and
    one aggregation stand for the four outer joins of the latest day with its
    baselines; the filter on ``date`` prunes partitions.
    """
    anchors = anchor_numbers(as_of)
    date = F.col("date")
    percent = widened(F.col("percent"), snapshots.schema["percent"].dataType)
    on_day = [
        F.max(F.when(date == anchor, percent)).alias(period)
        for period, anchor in anchors.items()
    ]
    listed = F.max(date == anchors["latest"]).alias("listed")
    return (
        snapshots.where(date.isin(list(anchors.values())))
        .groupBy("code")
        .agg(listed, *on_day)
        .where("listed")
        .select("code", *[(F.col("latest") - F.col(h)).alias(h) for h in HORIZONS])
    )
