"""Keyed tables: a folder per version, the newest finished one counts.

A version is never changed once written, so readers of the one before are not
disturbed, and a write that fails leaves no trace a reader would see.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.numbers import stored


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Finished versions, oldest first."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        finished = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and files.exists(finished):
            found.append(int(name[1:]))
    return sorted(found)


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version, None before the first write."""
    versions = _versions(spark, root)
    return spark.read.parquet(f"{root}/v{versions[-1]}") if versions else None


def replace(df: DataFrame, root: str) -> None:
    """Make ``df`` the whole table.

    A writer takes its version number by creating the folder, which fails for a number
    that another writer has taken; of two writers both versions stay, the later counts.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = _versions(spark, root)
    number = versions[-1] + 1 if versions else 1
    while not files.createNewFile(path(f"{root}/_taken-v{number}")):
        number += 1
    df.write.mode("overwrite").parquet(f"{root}/v{number}")


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all finished versions but the newest ``keep``."""
    jvm = spark.sparkContext._jvm
    for number in _versions(spark, root)[: -max(keep, 1)]:
        folder = jvm.org.apache.hadoop.fs.Path(f"{root}/v{number}")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder, True)


def upserted(current: DataFrame | None, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` and the rows of ``current`` whose key it does not have."""
    if current is None:
        return df
    return current.join(df.select(*keys), list(keys), "left_anti").unionByName(
        df, allowMissingColumns=True
    )


def upsert(df: DataFrame, root: str, keys: Sequence[str]) -> None:
    """Put the rows of ``df`` by key; rows of other keys stay."""
    replace(upserted(read_table(df.sparkSession, root), df, keys), root)


def stored_rows(df: DataFrame) -> DataFrame:
    """Values the way keyed tables keep them."""
    return df.select(
        [stored(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )
