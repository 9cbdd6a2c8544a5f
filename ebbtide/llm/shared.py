"""What the operators share: tables, stored intermediate results, worker code."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import scratch_path

# Fixed value: the characters between words.
WHITE = " \t\n\x0b\x0c\r"
_BYTE_MIX = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64)


def ship(module: str) -> None:
    """Send a module's functions to the workers by value, so that the workers need
    no copy of this library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read from there.

    Later steps start from these files: they see the same rows even after executors
    have been lost, and nothing before is computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: list[str], size: int = 2 << 20) -> Iterator[slice]:
    """Parts of a batch that hold about ``size`` characters, or one longer text."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def known(text: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(text, F.lit(""))


def with_salted(rows: DataFrame, facts: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """``rows`` left-joined with ``facts`` (one row per ``key``) so that a frequent key
    spreads over ``salts`` tasks by its other columns. ``facts`` should be the smaller side: it is repeated
    once per salt."""
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    repeated = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        rows.withColumn("_salt", salt).join(repeated, [key, "_salt"], "left").drop("_salt")
    )


# Rows of one key beyond which a join deals the key out; and distinct keys that are
# told apart so by broadcast, at most.
HOT_ROWS = 20_000
MOST_HOT_KEYS = 1_000_000


def with_facts(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    how: str = "left",
    sizes: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Stored ``rows`` joined with ``facts`` (one row per ``key``), where a key may hold
    any part of the rows.

    Keys with more than ``hot_rows`` rows are counted first (``sizes`` may give the stored
    counts as ``key, rows``) and dealt out over as many parts as they have lots of
    ``hot_rows``; only their facts are repeated, once per part. Rows without a key are
    dealt out as well. The limit rises with the table so that hot keys are at most
    ``MOST_HOT_KEYS``.
    """
    hot_rows = hot_rows or HOT_ROWS
    total = (sizes.agg(F.sum("rows")).first()[0] or 0) if sizes else rows.count()
    if total <= hot_rows:
        return rows.join(facts, key, how)
    limit = max(hot_rows, total // MOST_HOT_KEYS)
    if sizes is None:
        sizes = rows.groupBy(key).agg(F.count("*").alias("rows"))
    parts = F.ceil(F.col("rows") / F.lit(limit)).cast("int").alias("_parts")
    hot = stored(sizes.where(F.col("rows") > limit).select(key, parts), "hot-keys")
    if hot.isEmpty():
        return rows.join(facts, key, how)
    hot = F.broadcast(hot)
    spot = F.xxhash64(*rows.columns, F.spark_partition_id())
    part = (
        F.when(F.col(key).isNull(), F.pmod(spot, F.lit(1 << 20)))
        .when(F.col("_parts").isNotNull(), F.pmod(spot, F.col("_parts")))
        .otherwise(F.lit(0))
        .cast("int")
    )
    dealt = rows.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    last = F.coalesce("_parts", F.lit(1)) - 1
    repeated = facts.join(hot, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), last))
    )
    return dealt.join(repeated.drop("_parts"), [key, "_part"], how).drop("_part")


def only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is among the stored, distinct ``keys``, null keys included;
    a table of at most ``MOST_HOT_KEYS`` keys is broadcast."""
    keys = keys.select(F.col(key).alias("_key"))
    if keys.count() <= MOST_HOT_KEYS:
        keys = F.broadcast(keys)
    return rows.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def word_numbers(raw: np.ndarray) -> np.ndarray:
    """A number for each word of bytes that start and end with white space: the sum of
    a mix of each byte and its place in the word, as a difference of running sums."""
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    places = np.arange(len(raw), dtype=np.int32)
    origins = np.concatenate([[0], starts])
    places -= np.repeat(places[origins], np.diff(origins, append=len(raw)))
    mixed = _BYTE_MIX[raw] * (places.view(np.uint32) * np.uint64(2) + np.uint64(1))
    sums = np.cumsum(mixed ^ (mixed >> np.uint64(32)), dtype=np.uint64)
    return sums[ends - 1] - sums[starts - 1]


ship(__name__)
