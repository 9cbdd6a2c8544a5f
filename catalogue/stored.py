"""Stored tables: writing, replacing, looking up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import daily, inputs, sql
from ebbtide.functions.dates import shifted
from ebbtide.operators import lookup
from ebbtide.plans import hooks, jobs, movers, queries, rankings
from ebbtide.schemas import MARKS
from ebbtide.session import materialise, scratch_path
from ebbtide.sinks import keyed, marks
from ebbtide.sinks.buckets import read_buckets, rows_of_key, upsert_buckets
from ebbtide.sinks.days import write_days
from ebbtide.sinks.records import keyed_records
from ebbtide.sinks.series import read_series, write_series


def series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All normalised event days as the stored time-series table."""
    path = scratch_path(spark, "series")
    jobs.ingest_series(inputs.event_snapshots(spark, sf_dir), path)
    return spark.read.parquet(path)


def ranked_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ranked")
    jobs.ingest_ranked(inputs.event_snapshot(spark, sf_dir), path)
    return keyed.read_table(spark, path)


def mover_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ordered, coded = scratch_path(spark, "ordered"), scratch_path(spark, "coded")
    day = inputs.event_day(spark, sf_dir)
    rows = inputs.event_snapshots(spark, sf_dir, inputs.anchor_days(day), inputs.PERCENT)
    jobs.ingest_movers(rows, day, ordered, coded)
    return keyed.read_table(spark, ordered), keyed.read_table(spark, coded)


SERIES = f"""SELECT name AS "Name", code AS "Code", shorts AS "Shorts", total AS "Total",
    round(percent, 6) AS "Percent", industry AS "Industry", date AS "Date"
    FROM ({sql.EVENT_SNAPSHOTS}) s"""
LEADER = f"""(SELECT code FROM ({sql.EVENT_SNAPSHOT}) l ORDER BY percent DESC, code LIMIT 1)"""
RANKED_STORED = f"""SELECT "Position", "Code", round("Percent", 6) AS "Percent"
    FROM ({sql.ranked(sql.EVENT_SNAPSHOT)}) r"""


def _rounded(text: str) -> str:
    changes = ", ".join(
        f'round("{h.title()}Change", 6) AS "{h.title()}Change"' for h in sql.HORIZONS
    )
    return f"SELECT * REPLACE ({changes}) FROM ({text}) m"


def _renamed(text: str, key: str) -> str:
    """Stored mover columns under the names a query answers with."""
    codes = [f'"{h.title()}Code" AS "{h}Code"' for h in sql.HORIZONS] if key == "order" else []
    changes = [f'"{h.title()}Change" AS "{h}Change"' for h in sql.HORIZONS]
    first = 'cast("Position" AS bigint) AS "order"' if key == "order" else '"Code" AS code'
    return f"SELECT {', '.join([first] + codes + changes)} FROM ({_rounded(text)}) n"


def _leader(spark: SparkSession, sf_dir: str) -> str:
    """The code with the highest percentage of the last day."""
    first = rankings.leading_codes(inputs.event_snapshot(spark, sf_dir), 1)
    return first.first()["Code"]


def top_shorts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.top_shorts(ranked_table(spark, sf_dir), queries.row_count("100"))


def top_movers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.top_movers(mover_tables(spark, sf_dir)[0], queries.row_count("50"))


def top_movers_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = mover_tables(spark, sf_dir)[0]
    return queries.top_movers(ordered, queries.row_count("50"), exact_count=True)


def coded_movers_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.decode_coded_rows(mover_tables(spark, sf_dir)[1])


def coded_movers_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.coded_movers(mover_tables(spark, sf_dir)[1], _leader(spark, sf_dir))


def _harmed(rows: DataFrame, number: Column, harms: dict[int, tuple[str, str | None]]):
    """Rows as text; by the last digit of ``number`` a column holds something else."""
    text, digit = movers.as_text(rows.withColumn("_digit", number % 10)), F.col("_digit")
    for last, (column, value) in harms.items():
        other = F.lit(value).cast("string")
        text = text.withColumn(column, F.when(digit == last, other).otherwise(F.col(column)))
    return text.drop("_digit")


def _harmed_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mover_tables(spark, sf_dir)[0]
    harms = {
        1: ("MonthChange", None), 2: ("YearChange", "1,5"), 3: ("WeekCode", None),
        4: ("Position", "4th"), 5: ("Position", None),
    }
    return _harmed(rows, F.col("Position"), harms)


def _harmed_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mover_tables(spark, sf_dir)[1]
    harms = {1: ("DayChange", None), 2: ("WeekChange", "n/a"), 3: ("Code", None)}
    return _harmed(rows, F.col("Code").cast("long"), harms)


def decode_ordered_harmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered movers as text with missing and unreadable slots, decoded."""
    return movers.decode_ordered(_harmed_ordered(spark, sf_dir))


def decode_coded_harmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes per code as text with missing and unreadable slots, decoded."""
    return movers.decode_coded(_harmed_coded(spark, sf_dir))


def _decoded_by_sql(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    spark = rows.sparkSession
    hooks.create_decoders(spark)
    rows.createOrReplaceTempView("harmed_rows")
    return movers.run_sql(
        spark, f"SELECT d.* FROM harmed_rows r, LATERAL {hooks.call(name, columns, 'r')} d"
    )


def decode_ordered_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the decoder as a table function within SQL text."""
    rows = _harmed_ordered(spark, sf_dir)
    return _decoded_by_sql(rows, "decode_ordered", movers.ORDERED_COLUMNS)


def decode_coded_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _harmed_coded(spark, sf_dir)
    return _decoded_by_sql(rows, "decode_coded", movers.CODED_COLUMNS)


def bucket_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions put by code and day into a table in buckets, then those of the last
    day again with another total."""
    root = scratch_path(spark, "buckets")
    rows = inputs.event_positions(spark, sf_dir)
    day = int(f"{inputs.event_day(spark, sf_dir):%Y%m%d}")
    upsert_buckets(rows, root, ["code", "date"])
    again = rows.where(F.col("date") == day).withColumn("total", -F.col("total"))
    upsert_buckets(again, root, ["code", "date"])
    return read_buckets(spark, root)


BUCKET_UPSERT = f"""SELECT code, date, shorts, percent,
    CASE WHEN date = (SELECT max(date) FROM ({sql.EVENT_POSITIONS}) q) THEN -total ELSE total END
    AS total FROM ({sql.EVENT_POSITIONS}) p"""


def bucket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of one code, from the bucket that holds it."""
    root = scratch_path(spark, "buckets")
    upsert_buckets(mover_tables(spark, sf_dir)[1], root, ["Code"])
    return rows_of_key(spark, root, Code=_leader(spark, sf_dir))


def top_movers_harmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movers query over slots that are missing or unreadable."""
    rows = mover_tables(spark, sf_dir)[0]
    harms = {1: ("MonthChange", None), 2: ("DayChange", "--"), 3: ("WeekCode", None)}
    harmed = _harmed(rows, F.col("Position"), harms)
    return queries.top_movers(harmed, queries.row_count("50"))


def coded_movers_harmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows per code that the query reads, some of them harmed."""
    rows = mover_tables(spark, sf_dir)[1]
    harms = {1: ("DayChange", None), 2: ("YearChange", "n/a")}
    return queries.decode_coded_rows(_harmed(rows, F.col("Code").cast("long"), harms))


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = mover_tables(spark, sf_dir)[1]
    return lookup.by_key(coded, "Code", _leader(spark, sf_dir))


def key_date_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = series_table(spark, sf_dir)
    day = int(f"{inputs.event_day(spark, sf_dir):%Y%m%d}")
    return lookup.by_key_and_sort(series, "Code", _leader(spark, sf_dir), "Date", day)


def batch_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of every code that had an event, by key."""
    keys = inputs.event_reports(spark, sf_dir).select(F.col("code").alias("Code")).distinct()
    return lookup.by_keys(mover_tables(spark, sf_dir)[1], "Code", keys)


def batch_lookup_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.by_keys(ranked_table(spark, sf_dir), "Position", range(100))


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = inputs.event_day(spark, sf_dir)
    low, high = queries.search_window("week", day)
    series = series_table(spark, sf_dir)
    return lookup.in_range(series, "Code", _leader(spark, sf_dir), "Date", low, high)


def scan_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, _ = queries.search_window("week", inputs.event_day(spark, sf_dir))
    return lookup.after(series_table(spark, sf_dir), "Date", low)


def scan_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading code's series from the day of a mark on."""
    day = inputs.event_day(spark, sf_dir)
    mark = f"{day - dt.timedelta(days=3)}T09:30:00+02:00"
    low, high = queries.search_window("latest", day, mark)
    series = series_table(spark, sf_dir)
    return lookup.in_range(series, "Code", _leader(spark, sf_dir), "Date", low, high)


def _top_series(ranked: DataFrame, series: DataFrame, day: dt.date) -> DataFrame:
    count = queries.row_count("100", most=None)
    return queries.top_series(ranked, series, count, "month", day)


def _points(per_code: DataFrame) -> DataFrame:
    """One row per point, with its place in the series."""
    return per_code.select("Code", F.posexplode("series")).select(
        "Code", "pos", "col.Date", "col.Percent"
    )


def top_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of the leading codes, straight from the reports.

    The codes are ranked once and stored. Reports of other codes are left out before
    they are merged, those of other days where they are read.
    """
    day = inputs.event_day(spark, sf_dir)
    ranked = materialise(rankings.leading_codes(inputs.event_snapshot(spark, sf_dir, day), 100))
    chosen = ranked.select(F.col("Code").alias("code"))
    span = shifted("month", day), F.lit(day)
    days = inputs.event_snapshots_of(spark, sf_dir, chosen, span)
    series = keyed.stored_rows(rankings.series_rows(days))
    return _points(_top_series(ranked, series, day))


def top_series_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the stored ranking and time series."""
    ranked, series = ranked_table(spark, sf_dir), series_table(spark, sf_dir)
    return _points(_top_series(ranked, series, inputs.event_day(spark, sf_dir)))


def top_series_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole answer as one JSON object, read back as rows."""
    ranked, series = ranked_table(spark, sf_dir), series_table(spark, sf_dir)
    per_code = _top_series(ranked, series, inputs.event_day(spark, sf_dir))
    shape = "map<string,array<struct<Date:int,Percent:double>>>"
    return (
        queries.series_json(per_code)
        .select(F.explode(F.from_json("json", shape)).alias("Code", "points"))
        .select("Code", F.inline("points"))
    )


_MONTH_START = sql.number(sql.shifted("month", sql.EVENT_DAY))


def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's series of all codes as documents of a bounded number of codes, read
    back as points."""
    path = scratch_path(spark, "series-documents")
    ranked, series = ranked_table(spark, sf_dir), series_table(spark, sf_dir)
    every = ranked.count()
    day = inputs.event_day(spark, sf_dir)
    write_series(queries.top_series(ranked, series, every, "month", day), path)
    points = read_series(spark, path).select("Code", F.inline("series"))
    return points.select("Code", "Date", "Percent")


SERIES_DOCUMENTS = f"""SELECT code AS "Code", date AS "Date", round(percent, 6) AS "Percent"
    FROM ({sql.EVENT_SNAPSHOTS}) s
    WHERE date BETWEEN {_MONTH_START} AND {sql.number(sql.EVENT_DAY)}"""


def top_shorts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading codes as one JSON array, read back as rows with their place in it."""
    answer = queries.answer_json(top_shorts_query(spark, sf_dir))
    shape = "array<struct<position:bigint,code:string,percent:double>>"
    return answer.select(F.posexplode(F.from_json("json", shape))).select("pos", "col.*")


TOP_SERIES = f"""WITH held AS MATERIALIZED (SELECT * FROM ({sql.EVENT_POSITIONS}) p
        WHERE date BETWEEN {_MONTH_START} AND {sql.number(sql.EVENT_DAY)}),
    top AS (SELECT c.code FROM ({sql.EVENT_CODES}) c
        LEFT JOIN held h ON h.code = c.code AND h.date = {sql.number(sql.EVENT_DAY)}
        ORDER BY coalesce(h.percent, 0) DESC, c.code LIMIT 100),
    days AS (SELECT DISTINCT date FROM held)
    SELECT t.code AS "Code",
        cast(row_number() OVER (PARTITION BY t.code ORDER BY d.date) - 1 AS integer) AS pos,
        d.date AS "Date", round(coalesce(h.percent, 0), 6) AS "Percent"
    FROM top t CROSS JOIN days d
    LEFT JOIN held h ON h.code = t.code AND h.date = d.date"""
_WEEK_START = sql.number(sql.shifted("week", sql.EVENT_DAY))


_ORDERED_ROWS = _rounded(daily.EVENT_ORDERED)
DECODED_ORDERED = f"""SELECT * REPLACE (cast("Position" AS bigint) AS "Position",
    CASE WHEN "Position" % 10 = 1 THEN 0.0::DOUBLE ELSE "MonthChange" END AS "MonthChange")
    FROM ({_ORDERED_ROWS}) o WHERE "Position" % 10 NOT IN (2, 3, 4, 5)"""
DECODED_CODED = f"""SELECT * REPLACE (
    CASE WHEN "Code" LIKE '%1' THEN 0.0::DOUBLE ELSE "DayChange" END AS "DayChange")
    FROM ({_rounded(daily.EVENT_CODED)}) c WHERE right("Code", 1) NOT IN ('2', '3')"""
_NUMBERS = ['"order"', *(f'"{h}Change"' for h in sql.HORIZONS)]
_NO_NUMBERS = ", ".join(
    f"CASE WHEN n % 10 IN (1, 2) THEN 0 ELSE {name} END AS {name}" for name in _NUMBERS
)
_NO_CODES = ", ".join(
    f"""CASE WHEN n % 10 = 3 THEN '' ELSE "{h}Code" END AS "{h}Code" """ for h in sql.HORIZONS
)
TOP_HARMED = f"""SELECT * EXCLUDE (n) REPLACE ({_NO_NUMBERS}, {_NO_CODES})
    FROM (SELECT *, "order" AS n FROM ({_renamed(daily.EVENT_ORDERED, "order")}) r) q
    WHERE n < 50"""


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "days")
    write_days(inputs.event_snapshots(spark, sf_dir), path)
    return spark.read.parquet(path)


def upsert_time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the last one once more with raised percentages."""
    path = scratch_path(spark, "series")
    jobs.ingest_series(inputs.event_snapshots(spark, sf_dir), path)
    again = inputs.event_snapshot(spark, sf_dir)
    jobs.ingest_series(again.withColumn("percent", F.col("percent") + 1), path)
    return spark.read.parquet(path)


UPSERTED = f"""SELECT * REPLACE (CASE WHEN "Date" = {sql.number(sql.EVENT_DAY)}
    THEN round("Percent" + 1, 6) ELSE "Percent" END AS "Percent") FROM ({SERIES}) s"""


def _two_rankings(spark: SparkSession, sf_dir: str, merge: bool) -> DataFrame:
    """A ranking of all codes, then the shorter one of codes with an event."""
    path = scratch_path(spark, "ranked")
    day = inputs.event_day(spark, sf_dir)
    jobs.ingest_ranked(inputs.event_snapshot(spark, sf_dir), path)
    jobs.ingest_ranked(inputs.event_positions(spark, sf_dir, [F.lit(day)]), path, merge)
    return keyed.read_table(spark, path)


def ranked_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_rankings(spark, sf_dir, merge=False)


def ranked_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_rankings(spark, sf_dir, merge=True)


_DAY_POSITIONS = f"""SELECT * FROM ({sql.EVENT_POSITIONS}) p
    WHERE date = {sql.number(sql.EVENT_DAY)}"""
SHORTER = f"""SELECT "Position", "Code", round("Percent", 6) AS "Percent"
    FROM ({sql.ranked(_DAY_POSITIONS)}) r"""
MERGED = f"""WITH old AS ({RANKED_STORED}), new AS ({SHORTER})
    SELECT * FROM new UNION ALL
    SELECT * FROM old WHERE "Position" NOT IN (SELECT "Position" FROM new)"""


def mark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mark moved to the first, the last and again the first event day."""
    path = scratch_path(spark, "marks")
    days = inputs.event_reports(spark, sf_dir)
    first, last = days.agg(F.min("date"), F.max("date")).first()
    for day in (first, last, first):
        marks.advance_mark(spark, path, marks.LATEST_DAY, day)
    marks.write_mark(spark, path, "first", str(first))
    return keyed.read_table(spark, path).select(MARKS.fieldNames())


MARK_ADVANCE = f"""SELECT 'latestDate' AS name_id, cast(max(date) AS varchar) AS date
    FROM ({sql.EVENT_REPORTS}) r
    UNION ALL SELECT 'first', cast(min(date) AS varchar) FROM ({sql.EVENT_REPORTS}) r"""


def keyed_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position as a keyed JSON record, written and read back."""
    path = scratch_path(spark, "records")
    rows = inputs.lineitem_positions(spark, sf_dir)
    keyed_records(rows, "code").write.json(path)
    shape = "code string, date int, shorts bigint, total bigint, percent double"
    return (
        spark.read.schema("key string, value string")
        .json(path)
        .select("key", F.from_json("value", shape).alias("r"))
        .select("key", "r.*")
    )


def stored_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of all event reports as a keyed table keeps them."""
    rows = inputs.event_reports(spark, sf_dir).select(
        "event_id", "event_type", (F.col("percent") / 7).alias("share")
    )
    return keyed.stored_rows(rows)


QUERIES = {
    "top_shorts_query": (
        top_shorts_query,
        f"""SELECT "Position" AS position, "Code" AS code, "Percent" AS percent
        FROM ({RANKED_STORED}) t WHERE "Position" < 100""",
    ),
    "top_movers_query": (
        top_movers_query,
        _renamed(daily.EVENT_ORDERED, "order") + ' WHERE "Position" < 50',
    ),
    "top_movers_exact": (
        top_movers_exact,
        _renamed(daily.EVENT_ORDERED, "order") + ' WHERE "Position" <= 50',
    ),
    "coded_movers_rows": (coded_movers_rows, _renamed(daily.EVENT_CODED, "code")),
    "coded_movers_lookup": (
        coded_movers_lookup,
        _renamed(daily.EVENT_CODED, "code") + f' WHERE "Code" = {LEADER}',
    ),
    "decode_ordered_harmed": (decode_ordered_harmed, DECODED_ORDERED),
    "decode_coded_harmed": (decode_coded_harmed, DECODED_CODED),
    "decode_ordered_by_sql": (decode_ordered_by_sql, DECODED_ORDERED),
    "decode_coded_by_sql": (decode_coded_by_sql, DECODED_CODED),
    "bucket_upsert": (bucket_upsert, BUCKET_UPSERT),
    "top_movers_harmed": (top_movers_harmed, TOP_HARMED),
    "coded_movers_harmed": (
        coded_movers_harmed,
        _renamed(daily.EVENT_CODED, "code") + """ WHERE right("Code", 1) NOT IN ('1', '2')""",
    ),
    "point_lookup": (
        point_lookup,
        _rounded(daily.EVENT_CODED) + f' WHERE "Code" = {LEADER}',
    ),
    "bucket_lookup": (
        bucket_lookup,
        _rounded(daily.EVENT_CODED) + f' WHERE "Code" = {LEADER}',
    ),
    "key_date_lookup": (
        key_date_lookup,
        SERIES + f" WHERE date = {sql.number(sql.EVENT_DAY)} AND code = {LEADER}",
    ),
    "batch_lookup": (
        batch_lookup,
        _rounded(daily.EVENT_CODED)
        + ' WHERE "Code" IN (SELECT cast(user_id AS varchar) FROM events)',
    ),
    "batch_lookup_positions": (
        batch_lookup_positions,
        f'SELECT * FROM ({RANKED_STORED}) t WHERE "Position" BETWEEN 0 AND 99',
    ),
    "range_scan": (
        range_scan,
        SERIES + f""" WHERE code = {LEADER} AND date BETWEEN {_WEEK_START}
        AND {sql.number(sql.EVENT_DAY)}""",
    ),
    "scan_since_mark": (
        scan_since_mark,
        SERIES + f""" WHERE code = {LEADER} AND date BETWEEN
        {sql.number(sql.days_back(sql.EVENT_DAY, 3))} AND {sql.number(sql.EVENT_DAY)}""",
    ),
    "scan_after": (scan_after, SERIES + f" WHERE date > {_WEEK_START}"),
    "top_series": (top_series, TOP_SERIES),
    "top_series_stored": (top_series_stored, TOP_SERIES),
    "top_series_json": (
        top_series_json,
        f'SELECT "Code", "Date", "Percent" FROM ({TOP_SERIES}) t',
    ),
    "series_documents": (series_documents, SERIES_DOCUMENTS),
    "top_shorts_json": (
        top_shorts_json,
        f"""SELECT cast("Position" AS integer) AS pos, "Position" AS position, "Code" AS code,
        "Percent" AS percent FROM ({RANKED_STORED}) t WHERE "Position" < 100""",
    ),
    "snapshot_roundtrip": (snapshot_roundtrip, sql.EVENT_SNAPSHOTS),
    "upsert_time_series": (upsert_time_series, UPSERTED),
    "ranked_replace": (ranked_replace, SHORTER),
    "ranked_merge": (ranked_merge, MERGED),
    "mark_advance": (mark_advance, MARK_ADVANCE),
    "keyed_json_records": (
        keyed_json_records,
        f"SELECT code AS key, * FROM ({sql.LINEITEM_POSITIONS}) p",
    ),
    "stored_values": (
        stored_values,
        """SELECT event_id, event_type, round(value / 7, 6) AS share FROM events""",
    ),
}
