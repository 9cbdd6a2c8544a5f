"""Exact duplicates of whole texts, found by combining copies in three steps.

Copies are merged where they are read, then within salted groups of their digest, then
the winners of the salts with each other. Each step groups by the text itself beside
its digest, so texts that share a digest stay apart. A group of copies that holds a
third of all rows leaves each task once per salt, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, stored

SALTS = 32
# A row's claim to stay is one number: its length times this, plus a number that falls
# with its id. Above every such number, and fixed-width, so hash aggregation applies.
_LENGTH_STEP = Decimal(2 * 10**19)
_ID_TOP = Decimal(2**63)


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(known(text), "[ \\t-\\r]+", "")


def _claim(length: Column, key: Column) -> Column:
    by_id = F.lit(_ID_TOP).cast("decimal(20,0)") - key.cast("decimal(20,0)")
    return (
        length.cast("decimal(10,0)") * F.lit(_LENGTH_STEP).cast("decimal(21,0)")
        + F.coalesce(by_id, F.lit(0).cast("decimal(21,0)"))
    ).cast("decimal(38,0)")


def _claimant(claim: Column) -> Column:
    rest = claim % F.lit(_LENGTH_STEP).cast("decimal(38,0)")
    return F.when(rest != 0, (F.lit(_ID_TOP).cast("decimal(20,0)") - rest).cast("long"))


def _keyed(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Id, claim, normalised text, its SHA-256, digest and salt of every row."""
    return (
        docs.select(
            F.col(key).cast("long").alias("id"),
            F.length(known(F.col(text))).alias("length"),
            normalised(F.col(text)).alias("norm"),
        )
        .withColumn("sha", F.unhex(F.sha2("norm", 256)))
        .select(
            "id",
            _claim(F.col("length"), F.col("id")).alias("claim"),
            "norm",
            "sha",
            digest(F.col("sha")).alias("digest"),
            F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"),
        )
    )


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = lambda sha: sha,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``sha``.

    Of equal normalised texts the longest original stays, then the smallest id; null ids
    come last. Null texts count as empty, and empty texts are one group. Rows that repeat
    an id and a text are each reported, and one of them stays. An empty table gives no
    rows. Other columns of ``docs`` are not read, so their names are free.

    ``digest`` maps the SHA-256 of a text to what rows are grouped by first; results do
    not depend on it.
    """
    keyed = _keyed(docs, key, text, digest)
    rows = stored(keyed.select("id", "sha", "digest", "salt"), "exact-rows")
    salted = keyed.groupBy("digest", "salt", "norm").agg(
        F.max("claim").alias("claim"), F.count("*").alias("size")
    )
    texts = (
        salted.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.max("claim").alias("claim"), F.sum("size").alias("size"))
    )
    groups = stored(
        texts.groupBy("digest").agg(
            F.count("*").alias("texts"),
            F.max("claim").alias("claim"),
            F.sum("size").alias("size"),
        ),
        "exact-groups",
    )
    alone = groups.where("texts = 1").drop("texts")
    spread = rows.select("digest", "salt").distinct().join(alone, "digest")
    counted = rows.groupBy("digest", "salt", "id", "sha").agg(F.count("*").alias("times"))
    found = counted.join(spread, ["digest", "salt"]).drop("digest", "salt")
    shared = groups.where("texts > 1").select("digest")
    if not shared.isEmpty():
        # Several texts under one digest: these few are told apart by the text again.
        again = keyed.join(shared, "digest", "left_semi")
        winners = again.groupBy("digest", "salt", "norm").agg(
            F.max("claim").alias("claim"), F.count("*").alias("size")
        )
        winners = winners.groupBy("digest", "norm").agg(
            F.max("claim").alias("claim"), F.sum("size").alias("size")
        )
        told = again.groupBy("digest", "norm", "id", "sha").agg(F.count("*").alias("times"))
        found = found.unionByName(
            told.join(winners, ["digest", "norm"]).drop("digest", "norm")
        )
    winner = _claimant(F.col("claim"))
    return found.select(
        "id",
        "sha",
        winner.alias("keep_id"),
        F.col("size").alias("group_size"),
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    ).select(
        "id",
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "sha",
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rules as in :func:`exact_groups`; of rows that repeat an id and a text one with the
    longest original stays, whatever their other columns hold.
    """
    names = docs.columns
    whole = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        F.col(key).cast("long").alias("id"),
        F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("sha"),
        F.length(known(F.col(text))).alias("size"),
    )
    kept = exact_groups(docs, key, text).where("kept").select("id", "sha").alias("k")
    same = F.col("d.id").eqNullSafe(F.col("k.id")) & (F.col("d.sha") == F.col("k.sha"))
    once = F.row_number().over(Window.partitionBy("id", "sha").orderBy(F.desc("size")))
    return (
        whole.alias("d")
        .join(kept, same, "left_semi")
        .withColumn("nth", once)
        .where("nth = 1")
        .select("row.*")
    )
