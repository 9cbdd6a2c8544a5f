"""Tables partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.schemas import SNAPSHOT_ROW

# Rows of a day one JSON document holds; a larger day takes several documents.
ROWS_PER_DOCUMENT = 100_000


def write_days(df: DataFrame, path: str, by: str = "date", sort: str = "code") -> None:
    """Replace the days ``df`` has, leave all others as they are.

    Rebalanced by day, so a large day is written by several tasks and small ones
    share a task; sorted by code, so a lookup reads few row groups.
    """
    (
        df.hint("rebalance", F.col(by))
        .sortWithinPartitions(by, sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def documents(snapshots: DataFrame, rows_per_document: int = ROWS_PER_DOCUMENT) -> DataFrame:
    """Days as ``{"result": [...]}`` documents, split where a day is large.

    How many documents a day takes is one number per calendar day, and broadcast.
    """
    shards = F.ceil(F.count("*") / rows_per_document).alias("shards")
    per_day = snapshots.groupBy("date").agg(shards)
    return (
        snapshots.join(F.broadcast(per_day), "date")
        .withColumn("shard", F.pmod(F.xxhash64("code"), "shards").cast("int"))
        .groupBy("date", "shard")
        .agg(F.collect_list(F.struct(*SNAPSHOT_ROW.fieldNames())).alias("result"))
    )


def write_documents(
    snapshots: DataFrame, path: str, rows_per_document: int = ROWS_PER_DOCUMENT
) -> None:
    """Days as JSON documents, one file each, under ``date=<yyyymmdd>/``.

    The days written replace those there before.
    """
    (
        documents(snapshots, rows_per_document)
        .drop("shard")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 1)
        .partitionBy("date")
        .json(path)
    )
