"""Text files as ordered lines.

Files are read in splits, so no task ever holds a whole file. A line's place in
its file is ``(block, seq)``: the byte offset of its split and a number that grows
within the split.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.dates import parse_instant
from ebbtide.functions.text import computed_once, split_fields
from ebbtide.session import materialise
from ebbtide.sources.quoted import plain_lines, whole_records

# Fixed value: lines ahead of the first record of a downloaded listing.
PREAMBLE_LINES = 3
# File names that text scans decompress.
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst)$"

# Where a line stands among all lines read, oldest file first. Files of one time come
# in the order of a number made from their path: paths in the rows to be compared
# would make the largest part of them.
LINE_ORDER = ("modified", "file_id", "block", "seq")
LINE_PLACE = ("file", *LINE_ORDER)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    modified_after: dt.datetime | None = None,
) -> DataFrame:
    """Lines with file, file size, modification time and place in the file."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    if modified_after is not None:
        # The option takes whole seconds; the exact comparison follows on the file's
        # metadata.
        moment = modified_after.astimezone(dt.UTC)
        reader = reader.option("timeZone", "UTC").option(
            "modifiedAfter", (moment - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
        )
    raw = reader.text(path)
    if modified_after is not None:
        changed = F.unix_micros("_metadata.file_modification_time")
        since = modified_after - dt.datetime.fromtimestamp(0, dt.UTC)
        raw = raw.where(changed > since // dt.timedelta(microseconds=1))
    return raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.xxhash64("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def changed_lines(spark: SparkSession, path: str | list[str], mark: str) -> DataFrame:
    """Lines of the files modified after an RFC 3339 mark.

    ``ValueError`` if the mark is missing or unreadable.
    """
    return read_lines(spark, path, modified_after=parse_instant(mark))


def newest_change(lines: DataFrame) -> DataFrame:
    """One row: the latest modification time read, as an RFC 3339 ``mark``."""
    return lines.agg(
        F.date_format(F.max("modified"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("mark")
    )


def modified_at(spark: SparkSession, path: str) -> dt.datetime | None:
    """When a file was last modified; None if it is not there."""
    if not exists(spark, path):
        return None
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    passed = dt.timedelta(milliseconds=files.getFileStatus(file).getModificationTime())
    return dt.datetime.fromtimestamp(0, dt.UTC) + passed


def exists(spark: SparkSession, path: str) -> bool:
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def file_names(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Every file, empty ones included, from the listing a scan starts with."""
    return [_plain(name) for name in _files(spark, path).inputFiles()]


def _plain(name: str) -> str:
    """One spelling of a file name; local ones come with one slash or three."""
    return re.sub("^file:/+", "file:/", unquote(name))


def empty_file_names(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files without content, which scans pass over."""
    files = _files(spark, path)
    filled = {_plain(row[0]) for row in files.select("_metadata.file_path").collect()}
    return [name for name in file_names(spark, path) if name not in filled]


def skip_preamble(lines: DataFrame, preamble: int = PREAMBLE_LINES) -> DataFrame:
    """Lines of each file without its first few and without an unended last one.

    Whether the last line has ended shows in the file's size; a compressed file's size
    does not tell, so its last line stays.

    The lines are stored first: the per-file facts and the lines they are joined
    with have to come from one numbering. The facts are one row per file, no more
    than the listing the driver holds, and are broadcast, so the lines of a large
    file stay spread out.
    """
    lines = materialise(lines)
    place = F.struct("block", "seq")
    files = lines.groupBy("file").agg(
        F.min(F.when(F.col("block") == 0, F.col("seq"))).alias("first_seq"),
        F.max(place).alias("last_place"),
        (
            ~F.col("file").rlike(COMPRESSED)
            & (F.sum(F.octet_length("line") + 1) > F.max("file_size"))
        ).alias("open_end"),
    )
    in_preamble = (F.col("block") == 0) & (F.col("seq") < F.col("first_seq") + preamble)
    unended = F.col("open_end") & (place == F.col("last_place"))
    return (
        lines.join(F.broadcast(files), "file")
        .where(~in_preamble & ~unended)
        .select(*lines.columns)
    )


def with_fields(lines: DataFrame, separator: str, breaks: bool = False) -> DataFrame:
    """Clean records with their array of ``fields``, NULL where quoting is broken, and
    ``stray`` lines of records that quoting breaks as a whole.

    With ``breaks`` a quoted field may hold line breaks; else each line is a record.
    Empty lines between records are left out.
    """
    if breaks:
        records = whole_records(lines, separator)
    else:
        records = plain_lines(lines).where("line <> ''").withColumn("stray", F.lit(False))
    fields = split_fields(F.col("line"), separator).alias("fields")
    return computed_once(records, (*LINE_PLACE, "stray"), "line", fields)


def broken_files(records: DataFrame) -> DataFrame:
    """The ``file`` of every file that has broken quoting anywhere."""
    broken = F.max(F.col("stray") | F.col("fields").isNull())
    return records.groupBy("file").agg(broken.alias("broken")).where("broken").select("file")


def delimited_rows(lines: DataFrame, separator: str = ",", breaks: bool = True) -> DataFrame:
    """Records as an array of fields, of any length, with their place."""
    return (
        with_fields(lines, separator, breaks)
        .where("fields is not null")
        .select("fields", *LINE_PLACE)
    )


def name_number(name: str, pattern: str) -> int | None:
    """The integer a file name carries, None if the pattern does not match."""
    match = re.search(pattern, name)
    return int(match[1]) if match else None


def path_number(column: Column, pattern: str) -> Column:
    """The integer a file path carries, NULL if the pattern does not match."""
    return F.regexp_extract(column, pattern, 1).try_cast("int")
