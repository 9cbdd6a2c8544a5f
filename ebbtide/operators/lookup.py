"""Reads of keyed tables, written as filters that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key lists up to this length travel inside the plan as an IN list.
IN_LIST_KEYS = 1000


def by_key(table: DataFrame, key: str, value) -> DataFrame:
    """The row of a key, none if the key is missing."""
    return table.where(F.col(key) == value).limit(1)


def by_key_and_sort(table: DataFrame, key: str, value, sort: str, sort_value) -> DataFrame:
    return table.where((F.col(key) == value) & (F.col(sort) == sort_value)).limit(1)


def by_keys(table: DataFrame, key: str, values: Sequence | DataFrame) -> DataFrame:
    """The rows of the given keys; keys without a row are skipped.

    A long list or a DataFrame of keys becomes a semi join, whose strategy Spark
    picks by size. Listed keys of either length are read as the column's type; those
    that cannot be have no row.
    """
    if not isinstance(values, DataFrame):
        kind = table.schema[key].dataType
        texts = [None if value is None else str(value) for value in values]
        if len(texts) <= IN_LIST_KEYS:
            return table.where(F.col(key).isin([F.lit(text).try_cast(kind) for text in texts]))
        listed = table.sparkSession.createDataFrame([(text,) for text in texts], "k string")
        values = listed.select(F.col("k").try_cast(kind).alias(key))
    return table.join(values.select(key), key, "left_semi").select(*table.columns)


def in_range(
    table: DataFrame, key: str, value, sort: str, low: Column | int, high: Column | int
) -> DataFrame:
    """A key's rows with ``sort`` from ``low`` to ``high``, both included, in order."""
    return table.where((F.col(key) == value) & F.col(sort).between(low, high)).orderBy(sort)


def after(table: DataFrame, sort: str, start: Column | int) -> DataFrame:
    """All rows with ``sort`` past ``start``, ``start`` itself left out."""
    return table.where(F.col(sort) > start)
