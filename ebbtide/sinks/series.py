"""Series of any number of codes as JSON documents with a manifest.

One JSON object of all codes grows with their number. Here a document holds the series of
a bounded number of codes that follow each other in order, under ``documents/part=<n>/``,
and the manifest has one line per document with its first and last code, so that a
reader opens only the documents it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.rank import all_ranked

CODES_PER_DOCUMENT = 2000
POINTS = "array<struct<Date:int,Percent:double>>"


def write_series(
    per_code: DataFrame, path: str, codes_per_document: int = CODES_PER_DOCUMENT
) -> None:
    """Write the rows of :func:`ebbtide.plans.queries.top_series` (``Code``, unique and not
    null, and ``series``) as documents and their manifest, in place of those before.

    Codes are placed by a range sort, so no task sees all of them, and no row holds more
    than ``codes_per_document`` codes. Without codes there are no documents.
    """
    placed = all_ranked(per_code.select("Code", "series"), [F.asc("Code")], "place")
    part = F.floor(F.col("place") / F.lit(codes_per_document)).cast("int").alias("part")
    entries = F.array_sort(F.collect_list(F.struct("Code", "series")))
    documents = placed.groupBy(part).agg(F.map_from_entries(entries).alias("series"))
    documents.write.mode("overwrite").option(
        "maxRecordsPerFile", 1
    ).partitionBy("part").json(f"{path}/documents")
    manifest = placed.groupBy(part).agg(
        F.min("Code").alias("first"), F.max("Code").alias("last"), F.count("*").alias("codes")
    )
    # One short row per document.
    manifest.orderBy("part").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``first``, ``last`` and ``codes`` of every document."""
    shape = "part int, first string, last string, codes long"
    return spark.read.schema(shape).json(f"{path}/manifest")


def read_series(
    spark: SparkSession, path: str, codes: Sequence[str] | None = None
) -> DataFrame:
    """``Code`` and ``series`` of the documents, of all codes or of the few in ``codes``,
    for which only the documents that may hold them are opened."""
    found = spark.read.schema(f"series map<string,{POINTS}>, part int").json(f"{path}/documents")
    if codes is not None:
        manifest = read_manifest(spark, path)
        held = F.lit(False)
        for code in codes:
            held = held | F.lit(code).between(F.col("first"), F.col("last"))
        # At most as many parts as codes asked for.
        parts = [row.part for row in manifest.where(held).collect()]
        found = found.where(F.col("part").isin(parts))
    rows = found.select(F.explode("series").alias("Code", "series"))
    return rows if codes is None else rows.where(F.col("Code").isin(list(codes)))
