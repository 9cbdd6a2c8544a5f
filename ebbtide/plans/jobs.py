"""The jobs that keep the stored tables up to date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.dates import Day
from ebbtide.operators.changes import changes
from ebbtide.plans import movers, rankings
from ebbtide.plans.normalise import between_days, last_day, normalise_folder
from ebbtide.sinks.days import write_days
from ebbtide.sinks.keyed import replace, stored_rows, upsert
from ebbtide.sinks.marks import LATEST_DAY, advance_mark, read_mark
from ebbtide.sources.reports import report_days


def backfill(
    spark: SparkSession,
    listing_path: str,
    reports_path: str,
    day_table: str,
    marks: str,
    start: Day | None = None,
    end: Day | None = None,
) -> None:
    """Normalise all report days in a range at once, then move the mark.

    Either end may be open. A range without reports changes nothing.
    """
    found = between_days(report_days(spark, reports_path), start, end)
    newest = last_day(found).first()["date"]
    if newest is None:
        return
    write_days(normalise_folder(spark, listing_path, reports_path, start, end), day_table)
    advance_mark(spark, marks, LATEST_DAY, newest)


def ingest_series(snapshots: DataFrame, series_table: str) -> None:
    """Add normalised days to the time-series table, replacing those days."""
    write_days(
        stored_rows(rankings.series_rows(snapshots)), series_table, by="Date", sort="Code"
    )


def ingest_ranked(day: DataFrame, ranked_table: str, merge: bool = False) -> None:
    """Write the table of codes by percentage.

    With ``merge`` places past the end of a shorter list stay as they were.
    """
    _store(stored_rows(rankings.ranked_codes(day)), ranked_table, "Position", merge)


def ingest_movers(
    snapshots: DataFrame,
    as_of: Day,
    ordered_table: str,
    coded_table: str,
    merge: bool = False,
) -> None:
    """Write both movement tables from one pass over the snapshots."""
    wide = changes(snapshots, as_of).persist()
    try:
        ordered, coded = movers.ordered_changes(wide), movers.coded_changes(wide)
        _store(stored_rows(ordered), ordered_table, "Position", merge)
        _store(stored_rows(coded), coded_table, "Code", merge)
    finally:
        wide.unpersist()


def _store(rows: DataFrame, table: str, key: str, merge: bool) -> None:
    if merge:
        upsert(rows, table, [key])
    else:
        replace(rows, table)


def marked_day(spark: SparkSession, marks: str) -> dt.date:
    """The day movement reports refer to; ``ValueError`` before the first ingest."""
    mark = read_mark(spark, marks, LATEST_DAY)
    if mark is None:
        raise ValueError("no day has been ingested yet")
    return dt.datetime.strptime(mark, "%Y%m%d").date()
