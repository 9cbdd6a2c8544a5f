"""Keyed tables in buckets of their key: an upsert rewrites the buckets it touches, a
lookup reads the bucket of its key.

A table is a folder ``of=<buckets>`` with one partition ``bucket=<n>`` per bucket; the
number of buckets is set by the first write. Files carry Parquet's Bloom filters of the
key columns, so row groups without a key are passed over as well.

Touched buckets are replaced by dynamic partition overwrite: a job that fails before it
commits leaves the table as it was, and one that fails while it does is repeated. Readers
of untouched buckets are not disturbed; for readers of whole versions there are the
tables of :mod:`ebbtide.sinks.keyed`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import materialise

BUCKETS = 64
_LAYOUT = ("of", "bucket")


def bucket_of(columns: Sequence[Column], buckets: int) -> Column:
    """The bucket of a key, whose columns count as text."""
    return F.pmod(F.xxhash64(*[c.cast("string") for c in columns]), F.lit(buckets)).cast("int")


def buckets_of_table(spark: SparkSession, root: str) -> int | None:
    """How many buckets a table has; None before its first write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(path(f"{root}/of=*")) if files.exists(folder) else None
    names = [status.getPath().getName() for status in found or ()]
    return int(names[0].removeprefix("of=")) if names else None


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    """The whole table, None before its first write."""
    table = _table(spark, root)
    return None if table is None else table.drop(*_LAYOUT)


def _table(spark: SparkSession, root: str) -> DataFrame | None:
    if buckets_of_table(spark, root) is None:
        return None
    return spark.read.option("mergeSchema", True).parquet(root)


def upsert_buckets(
    df: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS
) -> list[int]:
    """Put the rows of ``df`` by key and return the buckets that were rewritten; rows of
    other keys stay, and so do the files of other buckets.

    Null keys are keys like others. Of rows in ``df`` that share a key all are put.
    ``buckets`` counts at the first write only. Columns that the table or ``df`` lacks
    are null. A key with many rows in ``df`` is spread when its bucket is written.
    """
    spark = df.sparkSession
    buckets = buckets_of_table(spark, root) or buckets
    place = bucket_of([F.col(key) for key in keys], buckets)
    new = materialise(df.withColumn("of", F.lit(buckets)).withColumn("bucket", place))
    # As many numbers as there are buckets at most.
    touched = sorted(row.bucket for row in new.select("bucket").distinct().collect())
    if not touched:
        return []
    current, rows = _table(spark, root), new
    if current is not None:
        current = current.where(F.col("bucket").isin(touched))
        given = new.select(*[F.col(key).alias(f"_{key}") for key in keys], F.col("bucket").alias("_b"))
        same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
        same.append(F.col("bucket") == F.col("_b"))
        left = current.join(given.distinct(), reduce(and_, same), "left_anti")
        # Stored first: the buckets that are read are about to be replaced.
        rows = materialise(left.unionByName(new, allowMissingColumns=True))
    writer = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *keys).write
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *_LAYOUT
    ).parquet(root)
    return touched


def rows_of_key(spark: SparkSession, root: str, **key) -> DataFrame | None:
    """The rows of a key, given as ``column=value`` for each of its columns in the order
    they were put by. Only the files of its bucket are read, and of these the row groups
    that may hold it. None before the first write."""
    table = _table(spark, root)
    if table is None:
        return None
    buckets = buckets_of_table(spark, root)
    typed = [F.lit(value).cast(table.schema[name].dataType) for name, value in key.items()]
    # One number, worked out ahead, so that the listing of partitions is cut by it.
    number = spark.range(1).select(bucket_of(typed, buckets).alias("n")).first().n
    found = table.where(F.col("bucket") == number)
    for name, value in zip(key, typed, strict=True):
        found = found.where(F.col(name).eqNullSafe(value) if key[name] is None else F.col(name) == value)
    return found.drop(*_LAYOUT)
