"""One row per key, the last one written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """``keys`` and ``values`` of each key's row that comes last in ``order``.

    An aggregate, not a window: rows of a frequent key are reduced where they are
    read, and at most one per task and key is shuffled. With a single number to
    order by, the aggregation buffers are fixed-width and hash aggregation applies;
    otherwise one struct is compared, ordered by ``order`` first.
    """
    if len(order) == 1:
        newest = [F.max_by(value, order[0]).alias(value) for value in values]
        return df.groupBy(*keys).agg(*newest)
    ordering = [F.col(name).alias(f"order_{i}") for i, name in enumerate(order)]
    newest = F.max(F.struct(*ordering, *values)).alias("newest")
    return (
        df.groupBy(*keys).agg(newest).select(*keys, *[f"newest.{value}" for value in values])
    )
