"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import ship, stored, with_facts


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the least node of
    its component.

    Each round points every node at its least neighbour, follows that pointer once
    more, and replaces the links by links between roots. A component that is not done
    at least halves, so the rounds grow with the logarithm of the largest component,
    and the links left shrink with each.
    """
    links = stored(links.where("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = stored(least.select("a", F.least("a", "least").alias("up")), "least")
        above = least.select(F.col("a").alias("up"), F.col("up").alias("top"))
        # Most nodes may point at one: such keys are dealt out.
        step = with_facts(least, above, "up", "inner").select("a", "top")
        step = stored(step, "contraction")
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("top").alias("root"))
        else:
            moved = with_facts(labels, step.withColumnRenamed("a", "root"), "root")
            labels = moved.select("node", F.coalesce("top", "root").alias("root"))
        labels = stored(labels, "labels")
        left = with_facts(links, step, "a", "inner").select(F.col("top").alias("a"), "b")
        left = stored(left, "half-links")
        left = with_facts(left, step.withColumnRenamed("a", "b"), "b", "inner")
        left = left.select("a", F.col("top").alias("b"))
        links = stored(left.where("a <> b").distinct(), "links")
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


ship(__name__)
