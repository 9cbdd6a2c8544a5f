"""Movement reports: rankings per horizon and changes per code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.dates import Day, anchor_numbers
from ebbtide.functions.numbers import NO_BASELINE, parse_double, parse_long, widened
from ebbtide.operators.changes import HORIZONS, changes
from ebbtide.operators.rank import LIMITED_RANKS, ranked_within

# Fixed value: how many ranks the report keeps.
REPORTED_RANKS = 99

ORDERED_COLUMNS = ["Position"] + [
    f"{h.title()}{part}" for h in HORIZONS for part in ("Code", "Change")
]
CODED_COLUMNS = ["Code"] + [f"{h.title()}Change" for h in HORIZONS]


def coded_movers(snapshots: DataFrame, as_of: Day) -> DataFrame:
    """The four changes of every code listed on the latest day."""
    return coded_changes(changes(snapshots, as_of))


def coded_changes(wide: DataFrame) -> DataFrame:
    """Changes per code as the report shows them."""
    return wide.select(
        F.col("code").alias("Code"),
        *[
            F.coalesce(F.col(h), F.lit(NO_BASELINE)).alias(f"{h.title()}Change")
            for h in HORIZONS
        ],
    )


def ordered_movers(
    snapshots: DataFrame,
    as_of: Day,
    ranks: int = REPORTED_RANKS,
    largest_first: bool = False,
) -> DataFrame:
    """Four rankings of all codes by size of change, side by side by rank."""
    return ordered_changes(changes(snapshots, as_of), ranks, largest_first)


def ordered_changes(
    wide: DataFrame, ranks: int = REPORTED_RANKS, largest_first: bool = False
) -> DataFrame:
    """Changes per code ranked within each horizon, one row per rank.

    The smallest change comes first unless ``largest_first``; codes without a
    baseline come last. The wide table of changes is read once for all four
    horizons, and each task passes on at most ``ranks`` rows per horizon; above
    ``LIMITED_RANKS`` ranks a horizon is sorted over ranges of its rows instead.
    """
    size = F.abs("change")
    by_size = size.desc_nulls_last() if largest_first else size.asc_nulls_last()
    changed = wide.unpivot(["code"], list(HORIZONS), "horizon", "change")
    deep = ranks > LIMITED_RANKS
    if deep:
        ranked = ranked_within(changed, "horizon", [by_size, F.asc("code")], "place")
        ranked = ranked.withColumn("Position", (F.col("place") + 1).cast("int"))
    else:
        within = Window.partitionBy("horizon").orderBy(by_size, "code")
        ranked = changed.withColumn("Position", F.row_number().over(within))
    ranked = ranked.where(F.col("Position") <= ranks)
    side_by_side = []
    for h in HORIZONS:
        here = F.col("horizon") == h
        change = F.coalesce(F.col("change"), F.lit(NO_BASELINE))
        side_by_side.append(F.max(F.when(here, F.col("code"))).alias(f"{h.title()}Code"))
        side_by_side.append(F.max(F.when(here, change)).alias(f"{h.title()}Change"))
    rows = ranked.groupBy("Position").agg(*side_by_side).orderBy("Position")
    # There are no more rows than ranks, so sorting a few takes no range exchange.
    return rows if deep else rows.limit(ranks)


def create_anchor_views(snapshots: DataFrame, as_of: Day) -> dict[str, DataFrame]:
    """Temporary views ``year``, ``month``, ``week``, ``day`` and ``latest``.

    Each has ``dateTime``, ``code`` and ``percent`` of the snapshot of its day.
    """
    percent = widened(F.col("percent"), snapshots.schema["percent"].dataType)
    views = {}
    for period, anchor in anchor_numbers(as_of).items():
        views[period] = snapshots.where(F.col("date") == anchor).select(
            F.col("date").cast("string").alias("dateTime"), "code", percent.alias("percent")
        )
        views[period].createOrReplaceTempView(period)
    return views


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """Result of SQL over the registered views, whole and typed."""
    return spark.sql(query)


def decode_ordered(rows: DataFrame) -> DataFrame:
    """Ordered movers from result rows of text columns named as the report.

    A row goes if its rank is missing or no number, if any code is missing, or if
    any change is no number; a missing change is 0.
    """
    codes = [f"{h.title()}Code" for h in HORIZONS]
    rank = parse_long(F.col("Position"))
    return _decoded(rows, rank.isNotNull(), [rank.alias("Position")], codes).select(
        ORDERED_COLUMNS
    )


def decode_coded(rows: DataFrame) -> DataFrame:
    """Changes per code from text columns, by the rules of :func:`decode_ordered`."""
    return _decoded(rows, F.lit(True), [], ["Code"]).select(CODED_COLUMNS)


def _decoded(rows: DataFrame, keep, keys: list, codes: list[str]) -> DataFrame:
    parsed = []
    for code in codes:
        keep = keep & F.col(code).isNotNull()
    for h in HORIZONS:
        text = F.col(f"{h.title()}Change")
        value = F.when(text.isNull(), F.lit(0.0)).otherwise(parse_double(text))
        keep = keep & value.isNotNull()
        parsed.append(value.alias(f"{h.title()}Change"))
    return rows.where(keep).select(*keys, *codes, *parsed)


def as_text(rows: DataFrame) -> DataFrame:
    """All columns as text, the form in which a remote result arrives."""
    return rows.select(
        [F.col(f.name).cast(T.StringType()).alias(f.name) for f in rows.schema.fields]
    )


