"""Normalised days, rankings and movement reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import inputs, sql
from ebbtide.functions.numbers import NO_BASELINE
from ebbtide.operators.rank import all_ranked
from ebbtide.plans import movers, rankings
from ebbtide.plans.normalise import last_day


# More ranks than a window cuts where rows are read.
DEEP_RANKS = 5000


def dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.event_positions(spark, sf_dir)


def dedup_last_wins_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.lineitem_positions(spark, sf_dir)


def merge_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.event_snapshot(spark, sf_dir)


def backfill_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.event_snapshots(spark, sf_dir)


def backfill_grid_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.lineitem_snapshots(spark, sf_dir)


def max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_day(inputs.event_reports(spark, sf_dir))


def top_shorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.leading_codes(inputs.event_snapshot(spark, sf_dir), 100)


def full_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.ranked_codes(inputs.event_snapshot(spark, sf_dir))


def rank_all_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.lineitem_positions(spark, sf_dir).select("code", "date", "percent")
    order = [F.desc("percent"), F.asc("code"), F.asc("date")]
    return all_ranked(rows, order, "position")


def _lineitem_anchor_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.anchor_days(inputs.LINEITEM_DAY)
    return inputs.lineitem_snapshots(spark, sf_dir, days, inputs.PERCENT)


def _event_anchor_snapshots(spark: SparkSession, sf_dir: str, day: dt.date) -> DataFrame:
    return inputs.event_snapshots(spark, sf_dir, inputs.anchor_days(day), inputs.PERCENT)


def ordered_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = inputs.event_day(spark, sf_dir)
    rows = _event_anchor_snapshots(spark, sf_dir, day)
    return movers.ordered_movers(rows, day)


def ordered_movers_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = inputs.event_day(spark, sf_dir)
    rows = _event_anchor_snapshots(spark, sf_dir, day)
    return movers.ordered_movers(rows, day, largest_first=True)


def ordered_movers_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More ranks than a window's limit cuts."""
    day = inputs.event_day(spark, sf_dir)
    rows = _event_anchor_snapshots(spark, sf_dir, day)
    return movers.ordered_movers(rows, day, ranks=DEEP_RANKS)


def top_shorts_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankings.leading_codes(inputs.event_snapshot(spark, sf_dir), DEEP_RANKS)


def ordered_movers_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = inputs.event_day(spark, sf_dir)
    rows = inputs.event_positions(spark, sf_dir, inputs.anchor_days(day))
    return movers.ordered_movers(rows, day)


def ordered_movers_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lineitem_anchor_snapshots(spark, sf_dir)
    return movers.ordered_movers(rows, inputs.LINEITEM_DAY)


def coded_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = inputs.event_day(spark, sf_dir)
    rows = _event_anchor_snapshots(spark, sf_dir, day)
    return movers.coded_movers(rows, day)


def coded_movers_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lineitem_anchor_snapshots(spark, sf_dir)
    return movers.coded_movers(rows, inputs.LINEITEM_DAY)


def coded_movers_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.anchor_days(inputs.LINEITEM_DAY)
    rows = inputs.lineitem_positions(spark, sf_dir, days)
    return movers.coded_movers(rows, inputs.LINEITEM_DAY)


def anchor_views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    movers.create_anchor_views(_lineitem_anchor_snapshots(spark, sf_dir), inputs.LINEITEM_DAY)
    return movers.run_sql(
        spark,
        """WITH monthly AS (
            SELECT l.dateTime AS latest_day, m.dateTime AS month_day,
                l.percent - m.percent AS change
            FROM latest l LEFT JOIN month m ON l.code = m.code)
        SELECT latest_day, month_day, count(*) AS codes, max(change) AS highest,
            min(change) AS lowest
        FROM monthly GROUP BY latest_day, month_day""",
    )


ANCHOR_VIEWS_SQL = f"""WITH snap AS MATERIALIZED ({sql.LINEITEM_SNAPSHOTS}),
    latest AS (SELECT * FROM snap WHERE date = {sql.anchor('latest', sql.LINEITEM_DAY)}),
    month AS (SELECT * FROM snap WHERE date = {sql.anchor('month', sql.LINEITEM_DAY)})
    SELECT cast(l.date AS varchar) AS latest_day, cast(m.date AS varchar) AS month_day,
        count(*) AS codes, max(l.percent - m.percent) AS highest,
        min(l.percent - m.percent) AS lowest
    FROM latest l LEFT JOIN month m ON l.code = m.code GROUP BY 1, 2"""


_MOVED = """moved AS (
    SELECT l.code AS code, l.percent - d.percent AS day, l.percent - w.percent AS week,
        l.percent - m.percent AS month, l.percent - y.percent AS year
    FROM latest l LEFT JOIN day d ON l.code = d.code LEFT JOIN week w ON l.code = w.code
        LEFT JOIN month m ON l.code = m.code LEFT JOIN year y ON l.code = y.code)"""


def coded_movers_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes per code as SQL over the five views."""
    day = inputs.event_day(spark, sf_dir)
    movers.create_anchor_views(_event_anchor_snapshots(spark, sf_dir, day), day)
    columns = ", ".join(
        f"coalesce({h}, {NO_BASELINE}D) AS {h.title()}Change" for h in sql.HORIZONS
    )
    return movers.run_sql(spark, f"WITH {_MOVED} SELECT code AS Code, {columns} FROM moved")


def ordered_movers_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four rankings side by side as SQL over the five views."""
    movers.create_anchor_views(_lineitem_anchor_snapshots(spark, sf_dir), inputs.LINEITEM_DAY)
    columns = ", ".join(
        f"""max(CASE WHEN horizon = '{h}' THEN code END) AS {h.title()}Code,
        max(CASE WHEN horizon = '{h}' THEN coalesce(change, {NO_BASELINE}D) END)
            AS {h.title()}Change"""
        for h in sql.HORIZONS
    )
    return movers.run_sql(
        spark,
        f"""WITH {_MOVED}, placed AS (
            SELECT code, horizon, change, row_number() OVER (
                PARTITION BY horizon ORDER BY abs(change) NULLS LAST, code) AS Position
            FROM moved UNPIVOT INCLUDE NULLS
                (change FOR horizon IN ({", ".join(sql.HORIZONS)})) u)
        SELECT Position, {columns} FROM placed
        WHERE Position <= {movers.REPORTED_RANKS} GROUP BY Position""",
    )


def decode_ordered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movers.decode_ordered(movers.as_text(ordered_movers_positions(spark, sf_dir)))


def decode_coded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movers.decode_coded(movers.as_text(coded_movers_lineitem(spark, sf_dir)))


EVENT_CODED = sql.coded_movers(sql.EVENT_SNAPSHOTS, sql.EVENT_DAY)
LINEITEM_CODED = sql.coded_movers(sql.LINEITEM_SNAPSHOTS, sql.LINEITEM_DAY)
EVENT_ORDERED = sql.ordered_movers(sql.EVENT_SNAPSHOTS, sql.EVENT_DAY)
LINEITEM_ORDERED = sql.ordered_movers(sql.LINEITEM_SNAPSHOTS, sql.LINEITEM_DAY)
POSITIONS_ORDERED = sql.ordered_movers(sql.EVENT_POSITIONS, sql.EVENT_DAY)
DECODED_ORDERED = f"""SELECT * REPLACE (cast("Position" AS bigint) AS "Position")
    FROM ({POSITIONS_ORDERED}) o"""

QUERIES = {
    "dedup_last_wins": (dedup_last_wins, sql.EVENT_POSITIONS),
    "dedup_last_wins_lineitem": (dedup_last_wins_lineitem, sql.LINEITEM_POSITIONS),
    "merge_zero_fill": (merge_zero_fill, sql.EVENT_SNAPSHOT),
    "backfill_grid": (backfill_grid, sql.EVENT_SNAPSHOTS),
    "backfill_grid_lineitem": (backfill_grid_lineitem, sql.LINEITEM_SNAPSHOTS),
    "max_date": (max_date, f"SELECT max(date) AS date FROM ({sql.EVENT_REPORTS}) r"),
    "top_shorts": (top_shorts, sql.ranked(sql.EVENT_SNAPSHOT, 'WHERE "Position" < 100')),
    "top_shorts_deep": (
        top_shorts_deep,
        sql.ranked(sql.EVENT_SNAPSHOT, f'WHERE "Position" < {DEEP_RANKS}'),
    ),
    "full_ranking": (full_ranking, sql.ranked(sql.EVENT_SNAPSHOT)),
    "rank_all_positions": (
        rank_all_positions,
        f"""SELECT row_number() OVER (ORDER BY percent DESC, code, date) - 1 AS position,
        code, date, percent FROM ({sql.LINEITEM_POSITIONS}) p""",
    ),
    "ordered_movers": (ordered_movers, EVENT_ORDERED),
    "ordered_movers_largest": (
        ordered_movers_largest,
        sql.ordered_movers(sql.EVENT_SNAPSHOTS, sql.EVENT_DAY, "DESC"),
    ),
    "ordered_movers_deep": (
        ordered_movers_deep,
        sql.ordered_movers(sql.EVENT_SNAPSHOTS, sql.EVENT_DAY, ranks=DEEP_RANKS),
    ),
    "ordered_movers_positions": (ordered_movers_positions, POSITIONS_ORDERED),
    "ordered_movers_lineitem": (ordered_movers_lineitem, LINEITEM_ORDERED),
    "coded_movers": (coded_movers, EVENT_CODED),
    "coded_movers_lineitem": (coded_movers_lineitem, LINEITEM_CODED),
    "coded_movers_positions": (
        coded_movers_positions,
        sql.coded_movers(sql.LINEITEM_POSITIONS, sql.LINEITEM_DAY),
    ),
    "anchor_views_sql": (anchor_views_sql, ANCHOR_VIEWS_SQL),
    "coded_movers_sql": (coded_movers_sql, EVENT_CODED),
    "ordered_movers_sql": (ordered_movers_sql, LINEITEM_ORDERED),
    "decode_ordered_rows": (decode_ordered_rows, DECODED_ORDERED),
    "decode_coded_rows": (decode_coded_rows, LINEITEM_CODED),
}
