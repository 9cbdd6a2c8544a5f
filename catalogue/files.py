"""Report files made from the tables and read back, at once or as they arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import inputs, sql
from ebbtide.functions.dates import anchor_numbers
from ebbtide.operators.merge import merge_days
from ebbtide.plans.jobs import backfill
from ebbtide.plans.movers import run_sql
from ebbtide.plans.normalise import (
    land_lines,
    latest_listing,
    latest_positions,
    normalise_folder,
)
from ebbtide.schemas import LISTING
from ebbtide.session import scratch_path
from ebbtide.sinks import keyed, marks
from ebbtide.sinks.days import write_documents
from ebbtide.sinks.requests import read_requests, send_records
from ebbtide.sources import lines, reports, snapshots
from ebbtide.streaming.ingest import ingest_reports, publish_records

# Listed codes per file made here.
CODES_PER_FILE = 10_000

# Snapshot rows whose percentage is a double, as in the tables.
DOCUMENT = T.StructType(
    [
        T.StructField(
            "result",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("code", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("shorts", T.LongType()),
                        T.StructField("total", T.LongType()),
                        T.StructField("percent", T.DoubleType()),
                        T.StructField("industry", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as report lines, some of each kind of trouble.

    By type of event a line has a percentage that is no number, misses its total,
    pads its code, ends in a carriage return or is in a two-byte encoding.
    """
    kind = F.col("event_type")
    code = F.when(kind == "view", F.concat(F.lit(" "), "code", F.lit("  "))).otherwise(
        F.col("code")
    )
    percent = F.when(kind == "error", F.lit("n/a")).otherwise(F.col("percent").cast("string"))
    total = F.when(kind != "signup", F.col("total").cast("string"))
    line = F.concat_ws(
        "\t", F.concat(F.lit("USER "), "code"), code, F.col("shorts"), total, percent
    )
    return inputs.event_reports(spark, sf_dir).select(
        "event_id",
        F.col("date").alias("report_date"),
        F.when(kind == "click", F.concat(line, F.lit("\r")))
        .when(kind == "purchase", F.regexp_replace(line, "(.)", "$1\x00"))
        .otherwise(line)
        .alias("line"),
    )


def land_reports(report: DataFrame, path: str) -> None:
    """Report lines as one file per day, under the name that a report has."""
    (
        report.repartition("report_date")
        .sortWithinPartitions("report_date", "event_id")
        .select("report_date", "line")
        .write.mode("append")
        .partitionBy("report_date")
        .text(path)
    )
    spark = report.sparkSession
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folders = name(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in folders.globStatus(name(f"{path}/report_date=*/part-*")):
        folder = found.getPath().getParent()
        day = folder.getName().removeprefix("report_date=")
        folders.rename(found.getPath(), name(folder, f"RR{day}-001-SSDailyAggShortPos.csv"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "reports")
    land_reports(report_lines(spark, sf_dir), path)
    return path


def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.read_positions(spark, _landed(spark, sf_dir))
    percent = F.col("percent").cast("double").alias("percent")
    return rows.select("name", "code", "shorts", "total", percent, "date")


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = lines.read_lines(spark, _landed(spark, sf_dir))
    return reports.rejected_positions(landed).select("line", "date")


def report_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_days(spark, _landed(spark, sf_dir))


ACCEPTED = f"""SELECT 'USER ' || code AS name, code, shorts, total,
    cast(cast(percent AS float) AS double) AS percent, date
    FROM ({sql.EVENT_REPORTS}) r WHERE event_type NOT IN ('error', 'signup')"""
REJECTED = f"""SELECT concat_ws(chr(9), 'USER ' || code, code, cast(shorts AS varchar),
    CASE WHEN event_type <> 'signup' THEN cast(total AS varchar) END,
    CASE WHEN event_type = 'error' THEN 'n/a' ELSE cast(percent AS varchar) END) AS line, date
    FROM ({sql.EVENT_REPORTS}) r WHERE event_type IN ('error', 'signup')"""


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as listing lines, a file number and a place in the file.

    By segment a name is quoted, holds a separator and quotes, or the line has a
    field too many.
    """
    segment, name = F.col("industry"), F.col("name")
    name = (
        F.when(segment == "BUILDING", F.concat(F.lit('"'), name, F.lit('"')))
        .when(segment == "MACHINERY", F.concat(F.lit('"The ""'), name, F.lit('"", Ltd"')))
        .otherwise(name)
    )
    extra = F.when(segment == "FURNITURE", F.lit("more"))
    customers = inputs.event_codes(spark, sf_dir)
    return customers.select(
        F.floor(F.col("code").cast("bigint") / CODES_PER_FILE).alias("file_number"),
        F.col("code").cast("bigint").alias("place"),
        F.concat_ws(",", name, "code", segment, extra).alias("line"),
    )


def _land_listing(rows: DataFrame, path: str) -> None:
    (
        rows.repartition("file_number")
        .sortWithinPartitions("file_number", "place")
        .select("file_number", "line")
        .write.partitionBy("file_number")
        .text(path)
    )


def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "listing")
    _land_listing(listing_lines(spark, sf_dir), path)
    return latest_listing(reports.listing(lines.read_lines(spark, path)))


def preamble_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing files under three preamble lines each, cleaned, landed and read."""
    path, cleaned = scratch_path(spark, "listing"), scratch_path(spark, "cleaned")
    rows = listing_lines(spark, sf_dir)
    preamble = F.array(
        F.struct(F.lit(-3).cast("bigint").alias("place"), F.lit("Listed codes").alias("line")),
        F.struct(F.lit(-2).cast("bigint").alias("place"), F.lit("").alias("line")),
        F.struct(F.lit(-1).cast("bigint").alias("place"), F.lit("a,b,c").alias("line")),
    )
    heads = rows.select("file_number").distinct().select("file_number", F.inline(preamble))
    _land_listing(rows.unionByName(heads), path)
    land_lines(lines.skip_preamble(lines.read_lines(spark, path)), cleaned)
    return latest_listing(reports.listing(lines.read_lines(spark, cleaned)))


LISTED = f"""SELECT code, CASE WHEN industry = 'MACHINERY' THEN 'The "' || name || '", Ltd'
    ELSE name END AS name, industry FROM ({sql.EVENT_CODES}) c WHERE industry <> 'FURNITURE'"""


def quoted_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as listing records, some with line breaks within quotes.

    By segment a name holds a line break, a break with an empty line, separators and
    quotes, or a record is followed by a line that quoting breaks.
    """
    path = scratch_path(spark, "listing")
    segment, name = F.col("industry"), F.col("name")
    broken = F.concat(F.lit('"'), F.replace(name, F.lit("#"), F.lit('\n""No"", ')), F.lit('"'))
    apart = F.concat(F.lit('"'), name, F.lit('\n\nLtd"'))
    record = F.concat_ws(
        ",",
        F.when(segment == "BUILDING", apart).when(segment == "MACHINERY", broken).otherwise(name),
        "code",
        segment,
    )
    astray = F.concat(record, F.lit("\nbe"), F.lit('"side,'), "code", F.lit(",lost"))
    customers = inputs.event_codes(spark, sf_dir)
    rows = customers.select(
        F.floor(F.col("code").cast("bigint") / CODES_PER_FILE).alias("file_number"),
        F.col("code").cast("bigint").alias("place"),
        F.when(segment == "FURNITURE", astray).otherwise(record).alias("line"),
    )
    _land_listing(rows, path)
    return latest_listing(reports.listing(lines.read_lines(spark, path)))


QUOTED = f"""SELECT code, industry, CASE industry WHEN 'BUILDING' THEN name || chr(10) || chr(10) || 'Ltd'
    WHEN 'MACHINERY' THEN replace(name, '#', chr(10) || '"No", ') ELSE name END AS name
    FROM ({sql.EVENT_CODES}) c"""


def delimited_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as blank-separated records of varying length."""
    path = scratch_path(spark, "delimited")
    orders = inputs.table(spark, sf_dir, "orders")
    line = F.concat_ws(" ", "o_orderkey", "o_orderstatus", "o_orderpriority")
    orders.select(line).write.text(path)
    rows = lines.delimited_rows(lines.read_lines(spark, path), " ")
    return rows.select(
        F.get("fields", F.lit(0)).alias("first"),
        F.element_at("fields", -1).alias("last"),
        F.size("fields").alias("n_fields"),
    )


DELIMITED = """SELECT cast(o_orderkey AS varchar) AS first,
    string_split(o_orderpriority, ' ')[-1] AS last,
    cast(2 + len(string_split(o_orderpriority, ' ')) AS integer) AS n_fields FROM orders"""


def snapshot_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event days as JSON documents, read back as rows."""
    path = scratch_path(spark, "documents")
    write_documents(inputs.event_snapshots(spark, sf_dir), path, rows_per_document=10_000)
    return snapshots.read_documents(spark, path, DOCUMENT, r"date=(\d{8})/")


def document_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the documents of all event days that keeps some by their path."""
    path = scratch_path(spark, "documents")
    write_documents(inputs.event_snapshots(spark, sf_dir), path, 10_000)
    snapshots.create_document_view(spark, path, "daily_documents", DOCUMENT)
    day = inputs.event_day(spark, sf_dir)
    numbers = spark.range(1).select(*anchor_numbers(day).values()).first()
    wanted = ", ".join(f"'{number}'" for number in numbers)
    return run_sql(
        spark,
        rf"""WITH documents AS (
            SELECT regexp_extract(path, r'date=(\d*)(?=/)', 1) AS dateTime, result
            FROM daily_documents)
        SELECT dateTime, stock.code AS code, stock.percent AS percent
        FROM documents LATERAL VIEW explode(result) t AS stock
        WHERE dateTime IN ({wanted})""",
    )


DOCUMENT_VIEW = f"""SELECT cast(date AS varchar) AS "dateTime", code, percent
    FROM ({sql.EVENT_SNAPSHOTS}) s WHERE date IN (
    {', '.join(sql.anchor(p, sql.EVENT_DAY) for p in inputs.PERIODS)})"""


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as files with one JSON array each, read back as rows."""
    path = scratch_path(spark, "arrays")
    codes = inputs.event_codes(spark, sf_dir)
    arrays = codes.groupBy(
        F.floor(F.col("code").cast("bigint") / CODES_PER_FILE).alias("file_number")
    ).agg(F.to_json(F.collect_list(F.struct(*LISTING.fieldNames()))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return snapshots.read_json_rows(spark, path, LISTING)


FROM_FILES = sql.snapshots(
    sql.EVENT_CODES,
    f"""SELECT code, date, arg_max(shorts, shorts) AS shorts, arg_max(total, shorts) AS total,
    arg_max(percent, shorts) AS percent FROM ({ACCEPTED}) a GROUP BY code, date""",
)


def normalise_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report file normalised in one job; of a code's lines the last one counts."""
    path = _landed(spark, sf_dir)
    merged = merge_days(
        inputs.event_codes(spark, sf_dir),
        latest_positions(reports.read_positions(spark, path)),
        reports.report_days(spark, path),
    )
    return merged.withColumn("percent", F.col("percent").cast("double"))


def strict_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report file normalised, files judged as a whole: the last day's report has
    one line that quoting breaks, so it counts as empty."""
    listing, path = scratch_path(spark, "listing"), scratch_path(spark, "reports")
    _land_listing(listing_lines(spark, sf_dir), listing)
    report = report_lines(spark, sf_dir)
    last = report.agg(F.max("report_date").alias("report_date"))
    broken = last.select(F.lit(-1).cast("bigint").alias("event_id"), "report_date",
                         F.lit('USER "1"\t1\t1\t1\t1').alias("line"))
    land_reports(report.unionByName(broken), path)
    merged = normalise_folder(spark, listing, path, strict=True)
    return merged.withColumn("percent", F.col("percent").cast("double"))


def _over_days(codes: str, accepted: str, days: str) -> str:
    return f"""SELECT d.date, c.code, c.name, coalesce(p.shorts, 0) AS shorts,
    coalesce(p.total, 0) AS total, coalesce(p.percent, 0) AS percent, c.industry
    FROM ({codes}) c CROSS JOIN ({days}) d
    LEFT JOIN (SELECT code, date, arg_max(shorts, shorts) AS shorts,
        arg_max(total, shorts) AS total, arg_max(percent, shorts) AS percent
        FROM ({accepted}) a GROUP BY code, date) p
    ON p.code = c.code AND p.date = d.date"""


_REPORTED = f"SELECT DISTINCT date FROM ({sql.EVENT_REPORTS}) r"
STRICT = _over_days(
    LISTED,
    f"""SELECT * FROM ({ACCEPTED}) b
    WHERE date < (SELECT max(date) FROM ({sql.EVENT_REPORTS}) r)""",
    _REPORTED,
)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, from files that arrive in two lots."""
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "days")
    mark, ledger = scratch_path(spark, "marks"), scratch_path(spark, "ledger")
    report = report_lines(spark, sf_dir)
    halves = report.agg(
        F.floor((F.min("report_date") + F.max("report_date")) / 2).alias("middle")
    )
    middle = halves.first()["middle"]
    for lot in (report.where(F.col("report_date") <= middle),
                report.where(F.col("report_date") > middle)):
        land_reports(lot, landing)
        ingest_reports(
            spark,
            landing,
            lambda: inputs.event_codes(spark, sf_dir),
            table,
            mark,
            ledger,
        )
    newest = marks.read_mark(spark, mark, marks.LATEST_DAY)
    return spark.read.parquet(table).select(
        "code", "date", "industry", "name", "shorts", "total",
        F.col("percent").cast("double").alias("percent"),
        F.lit(int(newest)).alias("mark"),
    )


def _report_files(spark: SparkSession, path: str, day: str = "*"):
    """The file system of a landing folder, and its report files of a day."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = name(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(name(f"{path}/report_date={day}/*.csv"))
    return system, [status.getPath() for status in found]


def corrected_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, in three runs: the later days; the earlier ones, as copies that keep old
    times; then the last day's report corrected and the first one's emptied."""
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "days")
    mark, ledger = scratch_path(spark, "marks"), scratch_path(spark, "ledger")
    report = report_lines(spark, sf_dir)
    first, last = report.agg(F.min("report_date"), F.max("report_date")).first()
    middle = (first + last) // 2

    def ingest() -> None:
        codes = lambda: inputs.event_codes(spark, sf_dir)
        ingest_reports(spark, landing, codes, table, mark, ledger)

    land_reports(report.where(F.col("report_date") > middle), landing)
    ingest()
    newer = {str(path) for path in _report_files(spark, landing)[1]}
    land_reports(report.where(F.col("report_date") <= middle), landing)
    system, found = _report_files(spark, landing)
    for path in found:
        if str(path) not in newer:
            system.setTimes(path, 1_000_000_000_000, -1)
    ingest()
    for path in _report_files(spark, landing, str(last))[1]:
        system.delete(path, False)
    correction = F.regexp_replace("line", r"\t\x00?([0-9])([0-9\x00]*)\t([^\t]*)$", "\t9$1$2\t$3")
    land_reports(report.where(F.col("report_date") == last).withColumn("line", correction), landing)
    for path in _report_files(spark, landing, str(first))[1]:
        system.create(path, True).close()
    ingest()
    newest = marks.read_mark(spark, mark, marks.LATEST_DAY)
    return spark.read.parquet(table).select(
        "code", "date", "industry", "name", "shorts", "total",
        F.col("percent").cast("double").alias("percent"),
        F.lit(int(newest)).alias("mark"),
    )


CORRECTED = _over_days(
    sql.EVENT_CODES,
    f"""SELECT code, date, shorts, percent,
        CASE WHEN date = (SELECT max(date) FROM ({sql.EVENT_REPORTS}) r)
             THEN cast('9' || total AS bigint) ELSE total END AS total
    FROM ({ACCEPTED}) b WHERE date > (SELECT min(date) FROM ({sql.EVENT_REPORTS}) r)""",
    _REPORTED,
)

# Days before the last one that the registered backfill begins and ends.
BACKFILL_DAYS = (20, 5)


def ranged_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report days of a range normalised from a landing folder in one job, and the
    mark moved."""
    listing, table = scratch_path(spark, "listing"), scratch_path(spark, "days")
    mark = scratch_path(spark, "marks")
    _land_listing(listing_lines(spark, sf_dir), listing)
    day = inputs.event_day(spark, sf_dir)
    start, end = (day - dt.timedelta(days=days) for days in BACKFILL_DAYS)
    backfill(spark, listing, _landed(spark, sf_dir), table, mark, start, end)
    newest = marks.read_mark(spark, mark, marks.LATEST_DAY)
    return spark.read.parquet(table).select(
        "code", "date", "industry", "name", "shorts", "total",
        F.col("percent").cast("double").alias("percent"),
        F.lit(int(newest)).alias("mark"),
    )


_START, _END = (sql.number(sql.days_back(sql.EVENT_DAY, days)) for days in BACKFILL_DAYS)
_RANGE = f"{_REPORTED} WHERE date >= {_START} AND date < {_END}"
BACKFILLED = f"""SELECT f.*, (SELECT max(date) FROM ({_RANGE}) m) AS mark
    FROM ({_over_days(LISTED, ACCEPTED, _RANGE)}) f"""


def changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lots of files; the second is read past the mark the first one left."""
    path = scratch_path(spark, "reports")
    report = report_lines(spark, sf_dir)
    first, last = report.agg(F.min("report_date"), F.max("report_date")).first()
    middle = (first + last) // 2
    land_reports(report.where(F.col("report_date") <= middle), path)
    mark = lines.newest_change(lines.read_lines(spark, path)).first()["mark"]
    land_reports(report.where(F.col("report_date") > middle), path)
    rows = reports.positions(lines.changed_lines(spark, path, mark))
    return rows.select("code", "shorts", "date")


CHANGED = f"""SELECT code, shorts, date FROM ({ACCEPTED}) a
    WHERE date > (SELECT (min(date) + max(date)) // 2 FROM ({sql.EVENT_REPORTS}) r)"""


def published_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored positions as a stream of keyed JSON records, read back."""
    path, out = scratch_path(spark, "positions"), scratch_path(spark, "records")
    keyed.replace(inputs.event_positions(spark, sf_dir), path)
    stored = keyed.read_table(spark, path)
    stream = spark.readStream.schema(stored.schema).parquet(f"{path}/v1")
    publish_records(stream, "code", out, scratch_path(spark, "progress")).awaitTermination()
    shape = "code string, date int, shorts bigint, total bigint, percent double"
    return (
        spark.read.schema("key string, value string")
        .json(out)
        .select("key", F.from_json("value", shape).alias("r"))
        .select("key", "r.*")
    )


def sent_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored positions as a stream to a message sink, in requests of bounded size, read
    back from the requests that were published."""
    path, out = scratch_path(spark, "positions"), scratch_path(spark, "requests")
    keyed.replace(inputs.event_positions(spark, sf_dir), path)
    stored = keyed.read_table(spark, path)
    stream = spark.readStream.schema(stored.schema).parquet(f"{path}/v1")
    send_records(stream, "code", out, scratch_path(spark, "progress")).awaitTermination()
    shape = "code string, date int, shorts bigint, total bigint, percent double"
    return (
        read_requests(spark, out)
        .select(F.inline("records"))
        .select("key", F.from_json("value", shape).alias("r"))
        .select("key", "r.*")
    )


QUERIES = {
    "tsv_scan": (tsv_scan, ACCEPTED),
    "rejected_rows": (rejected_rows, REJECTED),
    "report_days": (report_days, f"SELECT DISTINCT date FROM ({sql.EVENT_REPORTS}) r"),
    "listing_scan": (listing_scan, LISTED),
    "preamble_skip": (preamble_skip, LISTED),
    "quoted_listing": (quoted_listing, QUOTED),
    "strict_reports": (strict_reports, STRICT),
    "delimited_rows": (delimited_rows, DELIMITED),
    "snapshot_unnest": (snapshot_unnest, sql.EVENT_SNAPSHOTS),
    "document_view_sql": (document_view_sql, DOCUMENT_VIEW),
    "json_array_scan": (json_array_scan, sql.EVENT_CODES),
    "normalise_from_files": (normalise_from_files, FROM_FILES),
    "incremental_ingest": (
        incremental_ingest,
        f"""SELECT f.*, (SELECT max(date) FROM ({sql.EVENT_REPORTS}) r) AS mark
        FROM ({FROM_FILES}) f""",
    ),
    "corrected_ingest": (
        corrected_ingest,
        f"""SELECT f.*, (SELECT max(date) FROM ({sql.EVENT_REPORTS}) r) AS mark
        FROM ({CORRECTED}) f""",
    ),
    "ranged_backfill": (ranged_backfill, BACKFILLED),
    "changed_since": (changed_since, CHANGED),
    "sent_records": (sent_records, f"SELECT code AS key, * FROM ({sql.EVENT_POSITIONS}) p"),
    "published_records": (
        published_records,
        f"SELECT code AS key, * FROM ({sql.EVENT_POSITIONS}) p",
    ),
}
