"""The read queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.dates import Day, search_window
from ebbtide.functions.numbers import parse_double, parse_float, parse_long, widened
from ebbtide.operators.changes import HORIZONS
from ebbtide.operators.lookup import by_key

# How many rows a query gives unasked and at most.
DEFAULT_ROWS = 10
MOST_ROWS = 100

# A list of leading codes up to this length is broadcast.
BROADCAST_CODES = 10_000


def row_count(text: str | None, most: int | None = MOST_ROWS) -> int:
    """The number of rows a caller asks for; ``ValueError`` out of bounds."""
    if text is None:
        return DEFAULT_ROWS
    try:
        count = int(text)
    except ValueError:
        count = 0
    if count < 1 or (most is not None and count > most):
        raise ValueError(f"not a valid number of rows: {text!r}")
    return count


def _number(df: DataFrame, name: str, parse=parse_double) -> Column:
    """A stored number; text is parsed, NULL if it is none or absent."""
    if name not in df.columns:
        return F.lit(None)
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse(F.col(name))
    return F.col(name)


def top_shorts(ranked: DataFrame, count: int = DEFAULT_ROWS) -> DataFrame:
    """The first ``count`` places of the ranked table; an unreadable percentage is 0."""
    position = _number(ranked, "Position", parse_long)
    return (
        ranked.where(position < count)
        .select(
            position.alias("position"),
            F.col("Code").alias("code"),
            F.coalesce(_number(ranked, "Percent", parse_float), F.lit(0)).alias("percent"),
        )
        .orderBy("position")
        .limit(count)
    )


def top_movers(
    ordered: DataFrame, count: int = DEFAULT_ROWS, exact_count: bool = False
) -> DataFrame:
    """Movers by rank. Ranks start at 1 and places below ``count`` are asked for,
    so ``count - 1`` rows come back unless ``exact_count``.

    Within a row the numbers stand or fall together, and so do the codes: if one
    is missing or unreadable, all numbers are 0, or all codes empty.
    """
    last = count if exact_count else count - 1
    numbers = {"order": _number(ordered, "Position", parse_long)}
    codes = {}
    for h in HORIZONS:
        numbers[f"{h}Change"] = _number(ordered, f"{h.title()}Change")
        name = f"{h.title()}Code"
        codes[f"{h}Code"] = F.col(name) if name in ordered.columns else F.lit(None)
    all_numbers = _all_present(numbers.values())
    all_codes = _all_present(codes.values())
    decoded = {
        name: F.when(all_numbers, value)
        .otherwise(F.lit(0))
        .cast("long" if name == "order" else "double")
        for name, value in numbers.items()
    }
    decoded |= {name: F.when(all_codes, value).otherwise("") for name, value in codes.items()}
    names = ["order"] + [f"{h}{part}" for h in HORIZONS for part in ("Code", "Change")]
    return (
        ordered.where(numbers["order"] <= last)
        .select([decoded[name].alias(name) for name in names])
        .orderBy("order")
        .limit(last)
    )


def _all_present(columns) -> Column:
    present = F.lit(True)
    for column in columns:
        present = present & column.isNotNull()
    return present


def decode_coded_rows(coded: DataFrame) -> DataFrame:
    """Rows of the per-code table whose four changes are all readable."""
    values = {f"{h}Change": _number(coded, f"{h.title()}Change") for h in HORIZONS}
    return coded.where(_all_present(values.values())).select(
        F.col("Code").alias("code"),
        *[value.cast("double").alias(name) for name, value in values.items()],
    )


def coded_movers(coded: DataFrame, code) -> DataFrame:
    """The changes of one code; no row if it is unknown or unreadable."""
    return decode_coded_rows(by_key(coded, "Code", code))


def series_points(
    ranked: DataFrame,
    series: DataFrame,
    count: int,
    period: str,
    as_of: Day,
) -> DataFrame:
    """The dated percentages of the first ``count`` codes within a period.

    The short list of codes is what travels; the series, pruned to the dates of
    the window, stays where it is. An unreadable percentage is 0, a point with an
    unreadable date is left out.
    """
    if period == "latest":
        raise ValueError("a series needs a period of at least a day")
    low, high = search_window(period, as_of)
    codes = ranked.where(F.col("Position") < count).select("Code").distinct()
    if count <= BROADCAST_CODES:
        codes = F.broadcast(codes)
    percent = _number(series, "Percent")
    if not isinstance(series.schema["Percent"].dataType, T.StringType):
        percent = widened(percent, series.schema["Percent"].dataType)
    percent = F.coalesce(percent, F.lit(0.0))
    date = _number(series, "Date", parse_long).cast("int")
    return (
        series.where(date.between(low, high))
        .select("Code", date.alias("Date"), percent.alias("Percent"))
        .join(codes, "Code", "left_semi")
    )


def top_series(
    ranked: DataFrame,
    series: DataFrame,
    count: int = DEFAULT_ROWS,
    period: str = "week",
    as_of: Day | None = None,
) -> DataFrame:
    """One row per leading code with its ``series`` in order of date.

    A code without points in the period has an empty series. At most one point
    per calendar day of the period is gathered.
    """
    points = (
        series_points(ranked, series, count, period, as_of)
        .groupBy("Code")
        .agg(F.array_sort(F.collect_list(F.struct("Date", "Percent"))).alias("series"))
    )
    empty = F.array().cast(points.schema["series"].dataType)
    codes = ranked.where(F.col("Position") < count).select("Code").distinct()
    return codes.join(points, "Code", "left").select(
        "Code", F.coalesce("series", empty).alias("series")
    )


def series_map(per_code: DataFrame) -> DataFrame:
    """One row with the map from code to series of :func:`top_series`.

    For the short lists a caller asks for; the map grows with their length.
    """
    entries = F.array_sort(F.collect_list(F.struct("Code", "series")))
    return per_code.agg(F.map_from_entries(entries).alias("series"))


def series_json(per_code: DataFrame) -> DataFrame:
    """One row with :func:`series_map` as one JSON object, code to series."""
    return series_map(per_code).select(F.to_json("series").alias("json"))


def as_json(rows: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON object."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias(name))


def answer_json(rows: DataFrame) -> DataFrame:
    """One row with a query's rows as one JSON array, in order of the first column.

    For answers of a bounded number of rows, as :func:`row_count` allows.
    """
    objects = F.array_sort(F.collect_list(F.struct(*rows.columns)))
    return rows.agg(F.to_json(objects).alias("json"))
