"""Normalised days kept as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schemas import SNAPSHOT_DOCUMENT
from ebbtide.sources.lines import path_number

# Fixed value: how a snapshot file carries its day.
SNAPSHOT_FILE = r"(\d*)(?=\.json$)"
# How the folder of a day carries it.
DAY_FOLDER = r"/date=(\d+)/[^/]*$"


def read_json_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> DataFrame:
    """Rows of files that each hold one JSON array; a broken file fails the job."""
    rows = _json(spark, path, schema)
    return rows.select(*_zero_filled(schema))


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = SNAPSHOT_DOCUMENT,
    file_pattern: str | None = None,
) -> DataFrame:
    """Rows of ``{"result": [...]}`` documents with the day of their file, from the
    folder ``date=<yyyymmdd>`` it lies in or else from its name.

    A document without rows adds none; a broken one fails the job.
    """
    row = schema["result"].dataType.elementType
    return (
        _json(spark, path, schema)
        .select(
            _day(F.col("_metadata.file_path"), file_pattern).alias("date"),
            F.inline("result"),
        )
        .select("date", *_zero_filled(row))
    )


def _day(path: Column, file_pattern: str | None) -> Column:
    if file_pattern is not None:
        return path_number(path, file_pattern)
    return F.coalesce(path_number(path, DAY_FOLDER), path_number(path, SNAPSHOT_FILE))


def create_document_view(
    spark: SparkSession,
    path: str | list[str],
    name: str,
    schema: T.StructType = SNAPSHOT_DOCUMENT,
) -> DataFrame:
    """A view for SQL with each document's ``result`` array and its file ``path``."""
    documents = _json(spark, path, schema).select(
        "result", F.col("_metadata.file_path").alias("path")
    )
    documents.createOrReplaceTempView(name)
    return documents


def _json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .json(path)
    )


def _zero_filled(schema: T.StructType) -> list:
    """Fields a document leaves out read as empty text or zero."""
    return [
        F.coalesce(
            F.col(field.name),
            F.lit("" if isinstance(field.dataType, T.StringType) else 0).cast(field.dataType),
        ).alias(field.name)
        for field in schema.fields
    ]
