"""The whole pipeline over one set of folders: jobs by day, queries by argument."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.dates import (
    Day,
    backfill_range,
    business_days_back,
    day_text,
    days_back,
    parse_instant,
    series_period_name,
)
from ebbtide.plans import jobs, queries
from ebbtide.plans.normalise import clean_listing, land_lines, normalise_day
from ebbtide.sinks import keyed, marks
from ebbtide.sinks.days import write_days
from ebbtide.sources.lines import modified_at
from ebbtide.sources.reports import report_path

# How far behind the calendar the reports and the ingests run.
REPORT_LAG_BUSINESS_DAYS = 4
INGEST_LAG_DAYS = 4


@dataclasses.dataclass(frozen=True)
class Desk:
    """Folders of the pipeline and the jobs and queries that work on them."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, name: str) -> DataFrame:
        found = keyed.read_table(self.spark, self.path(name))
        if found is None:
            raise ValueError(f"the {name} table has not been written yet")
        return found

    def days(self) -> DataFrame:
        return self.spark.read.parquet(self.path("days"))

    def _text(self, column) -> str:
        return self.spark.range(1).select(column).first()[0]

    def report_day(self, as_of: Day) -> str:
        """The ``yyyymmdd`` whose report is due on ``as_of``."""
        return self._text(day_text(business_days_back(as_of, REPORT_LAG_BUSINESS_DAYS)))

    def ingest_day_number(self, as_of: Day) -> int:
        """The day whose snapshot is due for ingest on ``as_of``."""
        return int(self._text(day_text(days_back(as_of, INGEST_LAG_DAYS))))

    # Jobs.

    def fetch_listing(self, downloaded: str) -> None:
        """Land a downloaded listing without its preamble."""
        land_lines(clean_listing(self.spark, downloaded), self.path("listing"))

    def normalise(self, day: str, source: str) -> bool:
        """Normalise a day if its report changed since the mark of ``source``.

        False if there is no report or no change. ``ValueError`` if the mark is
        missing or unreadable.
        """
        report = report_path(self.path("reports"), day)
        marked = parse_instant(marks.read_mark(self.spark, self.path("marks"), source))
        changed = modified_at(self.spark, report)
        if changed is None or changed <= marked:
            return False
        merged = normalise_day(
            self.spark, self.path("listing"), self.path("reports"), day
        )
        write_days(merged, self.path("days"))
        marks.write_mark(self.spark, self.path("marks"), source, changed.isoformat())
        return True

    def backfill(self, as_of: Day, months: int) -> None:
        """Normalise every report in the range ``months`` spans around ``as_of``."""
        start, end = backfill_range(as_of, months)
        jobs.backfill(
            self.spark,
            self.path("listing"),
            self.path("reports"),
            self.path("days"),
            self.path("marks"),
            start,
            end,
        )

    def ingest_day(self, day: int) -> None:
        """Bring a normalised day into the series and make it the ranked one.

        ``ValueError``, and nothing changed, if the day is not there.
        """
        rows = self.days().where(F.col("date") == day)
        if rows.isEmpty():
            raise ValueError(f"no normalised day {day}")
        jobs.ingest_series(rows, self.path("series"))
        jobs.ingest_ranked(rows, self.path("ranked"))
        marks.write_mark(self.spark, self.path("marks"), marks.LATEST_DAY, str(day))

    def ingest_movers(self) -> None:
        """Rebuild both movement tables as of the marked day."""
        as_of = jobs.marked_day(self.spark, self.path("marks"))
        jobs.ingest_movers(self.days(), as_of, self.path("ordered"), self.path("coded"))

    # Queries. Counts and periods come as the text a caller gives.

    def top_shorts(self, number: str | None = None) -> DataFrame:
        return queries.top_shorts(self.table("ranked"), queries.row_count(number))

    def top_movers(self, number: str | None = None) -> DataFrame:
        return queries.top_movers(self.table("ordered"), queries.row_count(number))

    def movers_of(self, code: str) -> DataFrame:
        return queries.coded_movers(self.table("coded"), code)

    def top_series(
        self, as_of: dt.date, number: str | None = None, duration: str | None = None
    ) -> DataFrame:
        return queries.top_series(
            self.table("ranked"),
            self.spark.read.parquet(self.path("series")),
            queries.row_count(number, most=None),
            series_period_name(duration),
            as_of,
        )
