"""Keyed JSON records, for batch and streaming sinks alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_records(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``key`` and ``value``, the JSON of the whole record, as message sinks take them."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*(columns or df.columns))).alias("value"),
    )
