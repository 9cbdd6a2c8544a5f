"""Rankings, both of the first few rows and of all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import materialise

# monotonically_increasing_id keeps the partition above the lowest 33 bits.
_ROW_BITS = 33


# Window ranks up to this are cut where rows are read (Spark's own limit for that); more
# are numbered over sorted ranges.
LIMITED_RANKS = 1000


def first_ranked(df: DataFrame, order: Sequence[Column], count: int, name: str) -> DataFrame:
    """The first ``count`` rows in ``order`` with their 0-based place.

    Each task keeps its own first ``count`` rows, and only those meet in one place; above
    ``LIMITED_RANKS`` all rows are ranked, which ``order`` must be total for, and no
    rows meet in one place.
    """
    if count > LIMITED_RANKS:
        return all_ranked(df, order, name).where(F.col(name) < count)
    first = df.orderBy(*order).limit(count)
    return first.withColumn(
        name, F.row_number().over(Window.orderBy(*order)).cast("long") - 1
    )


def all_ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Every row with its 0-based place in ``order``, which must be total."""
    return ranked_within(df.withColumn("_all", F.lit(0)), "_all", order, name).drop("_all")


def ranked_within(
    df: DataFrame, group: str, order: Sequence[Column], name: str
) -> DataFrame:
    """Every row with its 0-based place in ``order`` among the rows of its ``group``; the
    order must be total within a group.

    A window would pull all rows of a group into one task. Here rows are range-sorted by
    group and order, so a large group spreads over tasks, and equal leading values by
    the later ones; rows are numbered within their partition. The stored numbering is
    then shifted by the group's rows in the partitions before, of which there are at
    most as many as shuffle partitions. Groups should be few: there is one row per
    group and partition that has it.
    """
    numbered = materialise(
        df.orderBy(group, *order).withColumn("_seq", F.monotonically_increasing_id())
    )
    numbered = numbered.withColumns(
        {
            "_chunk": F.shiftright("_seq", _ROW_BITS),
            "_row": F.col("_seq").bitwiseAND((1 << _ROW_BITS) - 1),
        }
    )
    earlier = (
        Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        numbered.groupBy(group, "_chunk")
        .agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select(F.col(group).alias("_group"), F.col("_chunk").alias("_part"), "_first", "_before")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_chunk") == F.col("_part"))
    return (
        numbered.join(F.broadcast(offsets), same)
        .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first"))
        .drop("_seq", "_chunk", "_row", "_group", "_part", "_first", "_before")
    )
