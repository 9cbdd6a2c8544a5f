"""Sources mixed to target weights by Poisson replication.

Every source has a target repetition rate: the share of all bytes it should have over
the share it has. A document is repeated as often as a Poisson variable of that mean
says, which is found by inverting its distribution at a uniform number that a hash of
the document's id and a seed give: the same run after run, whatever executor draws it.
The copies are dealt to random tasks and ordered by another hash within each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, ship, stored, with_salted

SEED = 17
# Up to this mean, terms are added from a count of 0 on; above, from one near the mean.
MOST_MEAN = 500.0
# Copies of a document that one task makes in a row.
LOT = 1000
# Sources whose rates are broadcast; more are joined by salted shuffles.
BROADCAST_SOURCES = 20_000
_DIGITS = 13  # hexadecimal digits of a hash that a float holds exactly


def uniform(key: Column, seed: int, use: str) -> Column:
    """A number from 0 up to 1 that a hash of the key decides."""
    text = F.concat_ws(":", key, F.lit(f"{seed}:{use}"))
    digits = F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double")
    return digits / F.lit(float(16**_DIGITS))


def poisson(rate: Column, chance: Column) -> Column:
    """The least count whose distribution function exceeds ``chance``.

    Chances are multiples of 2 ** -52, as :func:`uniform` gives them. Terms are added
    until none could change the sum: beyond the mean plus ten standard deviations and
    thirty they vanish in a float. Above ``MOST_MEAN`` they start twelve standard
    deviations below the mean, where all before add up to less than any chance but 0.
    """
    far = rate > MOST_MEAN
    low = F.when(far, F.floor(rate - 12 * F.sqrt(rate))).otherwise(F.lit(0).cast("long"))
    most = F.ceil(rate + 10 * F.sqrt(rate) + 30)
    first = F.when(far, _term(rate, F.greatest(low, F.lit(1)))).otherwise(F.exp(-rate))
    start = F.struct(low.alias("count"), first.alias("term"), first.alias("sum"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        more = state["sum"] <= chance
        return F.struct(
            F.when(more, k).otherwise(state["count"]).alias("count"),
            term.alias("term"),
            F.when(more, state["sum"] + term).otherwise(state["sum"]).alias("sum"),
        )

    counted = F.aggregate(F.sequence(low + 1, most), start, step, lambda s: s["count"])
    return F.when((chance <= 0) | (first > chance), F.lit(0).cast("long")).otherwise(counted)


def _term(rate: Column, count: Column) -> Column:
    """The chance of ``count``, at least 200, by Stirling's series. What the count's
    distance from the mean takes off is a series too, so that nothing cancels out."""
    v = (count - rate) / (count + rate)
    series = F.lit(0.0)
    for j in range(24, 0, -1):
        series = (series + F.lit(1.0 / (2 * j + 1))) * v * v
    distance = (count - rate) * v + 2 * count * v * series
    tail = 1 / (12 * count) - 1 / (360 * F.pow(count, F.lit(3))) + 1 / (1260 * F.pow(count, F.lit(5)))
    return F.exp(-distance - tail) / F.sqrt(2 * math.pi * count)


def rates(
    docs: DataFrame, targets: DataFrame | None, source: str = "source", text: str = "text"
) -> DataFrame:
    """``(source, rate)``: target share over actual share of all bytes, for every source
    with text. ``targets(source, weight)`` need not add up to one; sources without a
    weight, or with one below zero, get none. Without ``targets`` all sources weigh
    alike."""
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.octet_length(known(F.col(text)))).alias("bytes")
    )
    if targets is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = targets.select(
            F.col("source").alias("named"), F.col("weight").cast("double").alias("weight")
        )
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").select(
            "source", "bytes", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
        )
    weighed = weighed.where("bytes > 0")
    # One row of two sums, read as scalars.
    whole = weighed.agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(float(whole["weight"] or 1.0))
    return weighed.select(
        "source", (share * F.lit(float(whole["bytes"] or 0)) / F.col("bytes")).alias("rate")
    )


def copies(
    docs: DataFrame,
    targets: DataFrame | None = None,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as its draw says, in random order: ``row``
    (a struct of all their columns) and ``copy``, counted from 1.

    Rates as in :func:`rates`; rows without text belong to their source and are
    repeated at its rate, and a source without any text is left out. Null is a source
    like any other. Rows that repeat an id are drawn alike; without an id the text draws.
    An empty table gives no rows. Copies of documents with a mean above ``LOT`` are made
    in lots of so many, by tasks of their own.
    """
    names = docs.columns
    facts = rates(docs, targets, source, text).select(
        F.xxhash64("source", F.col("source").isNull()).alias("named"), "rate"
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        F.coalesce(
            F.col(key).cast("string"), F.concat(F.lit("text "), F.md5(known(F.col(text))))
        ).alias("id"),
        F.xxhash64(F.col(source), F.col(source).isNull()).alias("named"),
    )
    facts = stored(facts, "rates")
    # One row of two numbers.
    known_rates = facts.agg(F.count("*").alias("sources"), F.max("rate").alias("most")).first()

    def counted(facts: DataFrame) -> DataFrame:
        if known_rates["sources"] <= BROADCAST_SOURCES:
            drawn = rows.join(F.broadcast(facts), "named")
        else:
            drawn = with_salted(rows, facts, "named").where("rate IS NOT NULL")
        times = poisson(F.col("rate"), uniform(F.col("id"), seed, "count"))
        return drawn.withColumn("times", times).where("times > 0")

    def repeated(drawn: DataFrame, first: str, last: str) -> DataFrame:
        return drawn.select("row", "id", F.explode(F.expr(f"sequence({first}, {last})")).alias("copy"))

    if (known_rates["most"] or 0.0) <= LOT:
        every = repeated(counted(facts), "1L", "times")
    else:
        few = repeated(counted(facts.where(F.col("rate") <= LOT)), "1L", "times")
        lots = counted(facts.where(F.col("rate") > LOT)).select(
            "row", "id", "times", F.explode(F.expr(f"sequence(0L, (times - 1) div {LOT})")).alias("lot")
        )
        # A fixed number of partitions: by size they would be joined before they grow.
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lots = lots.repartition(parts, "id", "lot")
        many = repeated(lots, f"lot * {LOT} + 1", f"least(times, (lot + 1) * {LOT})")
        every = few.union(many)
    place = F.xxhash64(F.col("id"), "copy", F.lit(seed))
    dealt = every.withColumn("place", place).repartition(F.pmod("place", F.lit(1 << 20)))
    return dealt.sortWithinPartitions("place").select("row", "copy")


ship(__name__)
