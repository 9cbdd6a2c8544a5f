"""Named high-water marks."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ebbtide.operators.lookup import by_key
from ebbtide.schemas import MARKS
from ebbtide.sinks.keyed import read_table, upsert

# Fixed value: the mark of the newest normalised day.
LATEST_DAY = "latestDate"


def read_mark(spark: SparkSession, root: str, name: str) -> str | None:
    table = read_table(spark, root)
    row = by_key(table, "name_id", name).first() if table is not None else None
    return row["date"] if row else None


def write_mark(spark: SparkSession, root: str, name: str, value: str) -> None:
    """Set a mark; ``ValueError`` for an empty one."""
    if not value:
        raise ValueError("a mark needs a value")
    upsert(spark.createDataFrame([(name, value)], MARKS), root, ["name_id"])


def advance_mark(spark: SparkSession, root: str, name: str, value: int | str | None) -> None:
    """Move a ``yyyymmdd`` mark forward, never back."""
    if value is None:
        return
    current = read_mark(spark, root, name)
    if current is None or int(current) < int(value):
        write_mark(spark, root, name, str(value))
