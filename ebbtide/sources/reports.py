"""Listing files and daily short-position reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.numbers import parse_float, parse_long
from ebbtide.functions.text import computed_once
from ebbtide.sources.lines import (
    LINE_ORDER,
    LINE_PLACE,
    broken_files,
    file_names,
    name_number,
    path_number,
    read_lines,
    with_fields,
)

# Fixed value: how a report file carries its day.
REPORT_FILE = r"RR(\d{8})-001-SSDailyAggShortPos\.csv$"

LISTING_FIELDS = 3
POSITION_FIELDS = 5


def _field(position: int) -> Column:
    return F.get("fields", F.lit(position))


def listing(lines: DataFrame, breaks: bool = True, strict: bool = False) -> DataFrame:
    """Name, code and industry of the records with exactly three fields.

    Quoted fields may hold line breaks, unless ``breaks`` is off. With ``strict`` a file
    with broken quoting anywhere is an error: ``ValueError``.
    """
    records = with_fields(lines, ",", breaks or strict)
    if strict and (broken := broken_files(records).first()):
        raise ValueError(f"broken quoting in {broken.file}")
    fields = _listing_fields(records)
    return fields.where("valid").select("name", "code", "industry", *LINE_ORDER)


def rejected_listing(lines: DataFrame, breaks: bool = True) -> DataFrame:
    fields = _listing_fields(with_fields(lines, ",", breaks))
    return fields.where("not valid").select("line", *LINE_PLACE)


def _listing_fields(records: DataFrame) -> DataFrame:
    return computed_once(
        records,
        LINE_PLACE,
        "line",
        _field(0).alias("name"),
        _field(1).alias("code"),
        _field(2).alias("industry"),
        F.coalesce(F.size("fields") == LISTING_FIELDS, F.lit(False)).alias("valid"),
    )


def positions(
    lines: DataFrame,
    file_pattern: str = REPORT_FILE,
    breaks: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Well-formed positions with the ``yyyymmdd`` their file name carries.

    Reports are not quoted as a rule, so line breaks within quotes are looked for only
    with ``breaks``. With ``strict`` a file with broken quoting anywhere has no position.
    """
    columns = ("name", "code", "shorts", "total", "percent", "date")
    records = with_fields(lines, "\t", breaks or strict)
    found = _position_fields(records, file_pattern).where("valid")
    if strict:
        # One row per file at most.
        found = found.join(F.broadcast(broken_files(records)), "file", "left_anti")
    return found.select(*columns, *LINE_ORDER)


def rejected_positions(
    lines: DataFrame, file_pattern: str = REPORT_FILE, breaks: bool = False
) -> DataFrame:
    """Lines :func:`positions` leaves out, headers among them."""
    return (
        _position_fields(with_fields(lines, "\t", breaks), file_pattern)
        .where("not valid")
        .select("line", "date", *LINE_PLACE)
    )


def _position_fields(records: DataFrame, file_pattern: str) -> DataFrame:
    typed = computed_once(
        records,
        LINE_PLACE,
        "line",
        F.size("fields").alias("n_fields"),
        _field(0).alias("name"),
        F.trim(_field(1)).alias("code"),
        parse_long(_field(2)).alias("shorts"),
        parse_long(_field(3)).alias("total"),
        parse_float(_field(4)).alias("percent"),
        path_number(F.col("file"), file_pattern).alias("date"),
    )
    numeric = (
        F.col("shorts").isNotNull() & F.col("total").isNotNull() & F.col("percent").isNotNull()
    )
    right_length = F.coalesce(F.col("n_fields") == POSITION_FIELDS, F.lit(False))
    return typed.withColumn("valid", right_length & numeric)


def report_days(
    spark: SparkSession, path: str | list[str], file_pattern: str = REPORT_FILE
) -> DataFrame:
    """The days that have a report file, even one without a valid line."""
    names = file_names(spark, path)
    return days_of(spark, {name_number(name, file_pattern) for name in names} - {None})


def days_of(spark: SparkSession, numbers: set[int]) -> DataFrame:
    return spark.createDataFrame([(number,) for number in sorted(numbers)], "date int")


def read_positions(
    spark: SparkSession,
    path: str | list[str],
    file_pattern: str = REPORT_FILE,
    breaks: bool = False,
    strict: bool = False,
) -> DataFrame:
    return positions(read_lines(spark, path), file_pattern, breaks, strict)


def report_path(root: str, day: str) -> str:
    """Where the report of a ``yyyymmdd`` day lies under the landing folder."""
    return f"{root.rstrip('/')}/{day[:4]}/{day[4:6]}/RR{day}-001-SSDailyAggShortPos.csv"
