"""Normalised days: one row per listed code and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.dates import Day, day_number
from ebbtide.operators.dedup import last_wins
from ebbtide.operators.merge import MEASURES, merge_day, merge_days
from ebbtide.sources import lines, reports


def latest_listing(rows: DataFrame, order: tuple[str, ...] = lines.LINE_ORDER) -> DataFrame:
    """One row per code, the last one listed."""
    return last_wins(rows, ["code"], order, ["name", "industry"])


def latest_positions(rows: DataFrame, order: tuple[str, ...] = lines.LINE_ORDER) -> DataFrame:
    """One row per code and day, the last one reported."""
    return last_wins(rows, ["code", "date"], order, MEASURES)


def between_days(rows: DataFrame, start: Day | None, end: Day | None) -> DataFrame:
    """Rows dated from ``start`` up to, not including, ``end``; either may be open."""
    date = F.col("date")
    if start is not None:
        rows = rows.where(date >= day_number(start))
    if end is not None:
        rows = rows.where(date < day_number(end))
    return rows


def normalise_folder(
    spark: SparkSession,
    listing_path: str,
    reports_path: str | list[str],
    start: Day | None = None,
    end: Day | None = None,
    file_pattern: str = reports.REPORT_FILE,
    strict: bool = False,
) -> DataFrame:
    """All days of a landing folder, or those from ``start`` before ``end``. Only the
    files of these days are opened.

    With ``strict`` a file counts as a whole: a report with broken quoting anywhere is
    an empty one, a listing with broken quoting is a ``ValueError``.

    A day with a report but no valid line has every code at zero; a day without a
    report is absent.
    """
    listed = reports.listing(lines.read_lines(spark, listing_path), strict=strict)
    codes = latest_listing(listed)
    days = between_days(reports.report_days(spark, reports_path, file_pattern), start, end)
    # Calendar days only.
    numbers = {row["date"] for row in days.collect()}
    paths = [
        name
        for name in lines.file_names(spark, reports_path)
        if lines.name_number(name, file_pattern) in numbers
    ]
    rows = reports.read_positions(spark, paths or reports_path, file_pattern, strict=strict)
    if not paths:
        rows = rows.where(F.lit(False))
    return merge_days(codes, latest_positions(rows), days)


def normalise_day(
    spark: SparkSession, listing_path: str, reports_root: str, day: str
) -> DataFrame | None:
    """One ``yyyymmdd`` day of a landing folder; None if its report is not there."""
    path = reports.report_path(reports_root, day)
    if not lines.exists(spark, path):
        return None
    codes = latest_listing(reports.listing(lines.read_lines(spark, listing_path)))
    positions = latest_positions(reports.read_positions(spark, path))
    return merge_day(codes, positions, int(day))


def last_day(snapshots: DataFrame) -> DataFrame:
    """One row: the greatest ``date``, NULL without any."""
    return snapshots.agg(F.max("date").alias("date"))


def clean_listing(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a downloaded listing, ready to be landed with :func:`land_lines`."""
    return lines.skip_preamble(lines.read_lines(spark, path))


def land_lines(rows: DataFrame, path: str) -> None:
    """Write lines in their order as text."""
    rows.orderBy(*lines.LINE_ORDER).select("line").write.mode("overwrite").text(path)
