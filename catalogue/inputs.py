"""The given tables in the roles of codes, daily positions and report files.

Two sets of roles, each over whole tables:

* daily events: ``customer`` lists the codes, ``events`` reports positions;
* line items: ``supplier`` lists the codes, ``lineitem`` reports positions.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.dates import day_number, shifted, to_weekday
from ebbtide.operators.dedup import last_wins
from ebbtide.operators.merge import MEASURES, merge_day, merge_days

# The reference day of the line-item movers; all their baselines have data.
LINEITEM_DAY = dt.date(2001, 10, 16)
PERCENT = ("percent",)
PERIODS = ("latest", "day", "week", "month", "year")


@functools.lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the files once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def anchor_days(as_of: dt.date) -> list[Column]:
    return [to_weekday(shifted(period, as_of)) for period in PERIODS]


def _on_days(rows: DataFrame, moment: str, days: list[Column] | None) -> DataFrame:
    """Rows of some days, as ranges of the raw column so that they reach the scan."""
    if days is None:
        return rows
    wanted = F.lit(False)
    for day in days:
        start = day.cast("timestamp_ntz")
        end = F.date_add(day, 1).cast("timestamp_ntz")
        wanted = wanted | ((F.col(moment) >= start) & (F.col(moment) < end))
    return rows.where(wanted)


def _within(rows: DataFrame, moment: str, span: tuple[Column, Column] | None) -> DataFrame:
    """Rows from one day to another, both included, as a range of the raw column."""
    if span is None:
        return rows
    first, last = span
    end = F.date_add(last, 1).cast("timestamp_ntz")
    return rows.where((F.col(moment) >= first.cast("timestamp_ntz")) & (F.col(moment) < end))


def event_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("industry"),
    )


def event_reports(
    spark: SparkSession,
    sf_dir: str,
    days: list[Column] | None = None,
    span: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Every event as a reported position; ``event_id`` orders the reports."""
    rows = _within(_on_days(table(spark, sf_dir, "events"), "ts", days), "ts", span)
    return rows.select(
        F.col("user_id").cast("string").alias("code"),
        day_number(F.col("ts").cast("date")).alias("date"),
        F.col("event_id").alias("shorts"),
        F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint").alias("total"),
        F.col("value").alias("percent"),
        "event_id",
        "event_type",
    )


def event_positions(
    spark: SparkSession, sf_dir: str, days: list[Column] | None = None
) -> DataFrame:
    return _latest_events(event_reports(spark, sf_dir, days))


def _latest_events(reports: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    return last_wins(reports, ["code", "date"], ["event_id"], measures)


def lineitem_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("code"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("industry"),
        )
    )


def lineitem_reports(
    spark: SparkSession, sf_dir: str, days: list[Column] | None = None
) -> DataFrame:
    return _on_days(table(spark, sf_dir, "lineitem"), "l_shipdate", days).select(
        F.col("l_suppkey").cast("string").alias("code"),
        day_number(F.col("l_shipdate").cast("date")).alias("date"),
        F.col("l_quantity").cast("bigint").alias("shorts"),
        F.col("l_orderkey").alias("total"),
        F.col("l_extendedprice").alias("percent"),
        "l_linenumber",
    )


def lineitem_positions(
    spark: SparkSession, sf_dir: str, days: list[Column] | None = None
) -> DataFrame:
    return _latest_lineitems(lineitem_reports(spark, sf_dir, days))


def _latest_lineitems(reports: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    order = ["percent", "total", "l_linenumber"]
    return last_wins(reports, ["code", "date"], order, measures)


def event_day(spark: SparkSession, sf_dir: str) -> dt.date:
    """The last day with events."""
    days = table(spark, sf_dir, "events").agg(F.max("ts").cast("date").alias("day"))
    return days.first()["day"]


def event_snapshots(
    spark: SparkSession,
    sf_dir: str,
    days: list[Column] | None = None,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Every code on every day (or on those of ``days``) that has events."""
    reports = event_reports(spark, sf_dir, days)
    positions = _latest_events(reports, measures)
    return merge_days(
        event_codes(spark, sf_dir), positions, reports.select("date"), measures
    )


def event_snapshots_of(
    spark: SparkSession, sf_dir: str, chosen: DataFrame, span: tuple[Column, Column]
) -> DataFrame:
    """The codes in ``chosen``, a list that a limit keeps short, on every day of the
    span that has events."""
    reports = event_reports(spark, sf_dir, span=span)
    few = F.broadcast(chosen.select("code"))
    return merge_days(
        event_codes(spark, sf_dir).join(few, "code", "left_semi"),
        _latest_events(reports.join(few, "code", "left_semi")),
        reports.select("date"),
    )


def event_snapshot(
    spark: SparkSession, sf_dir: str, day: dt.date | None = None
) -> DataFrame:
    """Every code on the last day, which a caller may know already."""
    day = day or event_day(spark, sf_dir)
    positions = event_positions(spark, sf_dir, [F.lit(day)])
    return merge_day(event_codes(spark, sf_dir), positions, int(f"{day:%Y%m%d}"))


def lineitem_snapshots(
    spark: SparkSession,
    sf_dir: str,
    days: list[Column] | None = None,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    reports = lineitem_reports(spark, sf_dir, days)
    positions = _latest_lineitems(reports, measures)
    return merge_days(
        lineitem_codes(spark, sf_dir), positions, reports.select("date"), measures
    )
