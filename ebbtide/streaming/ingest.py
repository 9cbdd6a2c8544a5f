"""New and changed report files into the day table, each version once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbtide.operators.merge import merge_days
from ebbtide.plans.normalise import latest_positions
from ebbtide.session import materialise
from ebbtide.sinks.days import write_days
from ebbtide.sinks.keyed import drop_old_versions, read_table, upsert
from ebbtide.sinks.marks import LATEST_DAY, advance_mark
from ebbtide.sinks.records import keyed_records
from ebbtide.sources.lines import (
    LINE_ORDER,
    empty_file_names,
    file_names,
    modified_at,
    name_number,
    path_number,
)
from ebbtide.sources.reports import REPORT_FILE, days_of, read_positions

# Days whose reports are normalised in one job.
DAYS_PER_BATCH = 31
FILE = "path string, modified timestamp, length long"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Path, modification time and length of every file in a folder; no content is
    read. Scans pass over empty files, so these are taken from the listing."""
    filled = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path", F.col("modificationTime").alias("modified"), "length")
    )
    empty = [(name, modified_at(spark, name), 0) for name in empty_file_names(spark, landing)]
    return filled.union(spark.createDataFrame(empty, FILE))


def pending_files(spark: SparkSession, landing: str, ledger: str) -> DataFrame:
    """Files of which the ledger does not have this version: new ones, whatever their
    time, and ones changed or emptied since."""
    files = landed_files(spark, landing)
    taken = read_table(spark, ledger)
    if taken is None:
        return files
    return files.join(taken, ["path", "modified", "length"], "left_anti")


def ingest_reports(
    spark: SparkSession,
    landing: str,
    codes: Callable[[], DataFrame],
    day_table: str,
    marks: str,
    ledger: str,
    file_pattern: str = REPORT_FILE,
    days_per_batch: int = DAYS_PER_BATCH,
    order: tuple[str, ...] = LINE_ORDER,
    then: Callable[[DataFrame], None] | None = None,
) -> None:
    """Normalise the days of reports that landed or changed since the last run.

    Each version of a file (path, modification time, length) is taken once; the ledger
    is a keyed table of the versions taken. A streaming file source would pass over
    files with old times, as copies that keep their times have, and over corrected
    ones. A day is written whole, from all its files as they are now, the mark moves
    after its data and the ledger last, so a run after a failure ends in the same
    tables. An empty report makes a day of zeros. ``then`` gets the stored rows of each
    batch's days.
    """
    pending = materialise(
        pending_files(spark, landing, ledger).withColumn(
            "date", path_number(F.col("path"), file_pattern)
        )
    )
    # Calendar days only.
    numbers = sorted(r["date"] for r in pending.select("date").distinct().collect() if r["date"])
    names = file_names(spark, landing) if numbers else []
    for first in range(0, len(numbers), days_per_batch):
        chosen = set(numbers[first : first + days_per_batch])
        days = days_of(spark, chosen)
        paths = [name for name in names if name_number(name, file_pattern) in chosen]
        rows = read_positions(spark, paths, file_pattern)
        write_days(merge_days(codes(), latest_positions(rows, order), days), day_table)
        advance_mark(spark, marks, LATEST_DAY, max(chosen))
        if then is not None:
            then(spark.read.parquet(day_table).join(F.broadcast(days), "date", "left_semi"))
        taken = pending.where(F.col("date").isin(list(chosen)))
        upsert(taken.select("path", "modified", "length"), ledger, ["path"])
        drop_old_versions(spark, ledger)


def publish_records(
    rows: DataFrame, key: str, path: str, checkpoint: str, format: str = "json", **options
) -> StreamingQuery:
    """Write a stream as keyed JSON records, to files or a message sink."""
    return (
        keyed_records(rows, key)
        .writeStream.format(format)
        .options(path=path, checkpointLocation=checkpoint, **options)
        .trigger(availableNow=True)
        .start()
    )
