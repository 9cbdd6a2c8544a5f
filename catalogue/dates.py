"""Calendar functions over the days of all orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import sql
from catalogue.inputs import table
from ebbtide.functions import dates


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("d")
    ).distinct()


ORDER_DAYS = "SELECT DISTINCT cast(o_orderdate AS date) AS d FROM orders"


def _select(columns: dict, sql_columns: dict):
    """A query and its SQL: the day as a number, and columns computed from it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return order_days(spark, sf_dir).select(
            dates.day_number(F.col("d")).alias("d_number"),
            *[make(F.col("d")).alias(name) for name, make in columns.items()],
        )

    body = ", ".join(f"{expression} AS {name}" for name, expression in sql_columns.items())
    return run, f"SELECT {sql.number('d')} AS d_number, {body} FROM ({ORDER_DAYS}) o"


def _option(function, option):
    return lambda day: function(option, day)


DATE_ANCHORS = _select(
    {f"{p}_number": _option(dates.previous_weekday_number, o)
     for p, o in dates.PERIOD_OPTIONS.items()},
    {f"{p}_number": sql.anchor(p, "d") for p in dates.PERIOD_OPTIONS},
)
PREVIOUS_DATES = _select(
    {f"{p}_number": _option(dates.previous_day_number, o)
     for p, o in dates.PERIOD_OPTIONS.items()}
    | {"other_number": _option(dates.previous_day_number, 9)},
    {f"{p}_number": sql.number(sql.shifted(p, "d")) for p in dates.PERIOD_OPTIONS}
    | {"other_number": "0"},
)
WEEKDAY_BACKDATE = _select(
    {"weekday_number": lambda d: dates.day_number(dates.to_weekday(d))},
    {"weekday_number": sql.number(sql.to_weekday("d"))},
)
BUSINESS_DAYS_BACK = _select(
    {f"back_{n}": lambda d, n=n: dates.day_text(dates.business_days_back(d, n))
     for n in (0, 1, 3, 4, 7)},
    {f"back_{n}": sql.text(sql.business_days_back("d", n) if n else "d")
     for n in (0, 1, 3, 4, 7)},
)
MONTH_OVERFLOW = _select(
    {f"months_{n}": lambda d, n=n: dates.day_text(dates.months_back(d, n))
     for n in (1, 6, 13)}
    | {f"years_{n}": lambda d, n=n: dates.day_text(dates.years_back(d, n)) for n in (1, 4)},
    {f"months_{n}": sql.text(sql.months_back("d", n)) for n in (1, 6, 13)}
    | {f"years_{n}": sql.text(sql.months_back("d", 12 * n)) for n in (1, 4)},
)
DATE_STRINGS = _select(
    {
        "four_back": lambda d: dates.day_text(dates.days_back(d, 4)),
        "five_on": lambda d: dates.day_text(dates.days_forward(d, 5)),
        "read_back": lambda d: dates.day_number(dates.number_to_day(dates.day_text(d))),
    },
    {
        "four_back": sql.text("d - 4"),
        "five_on": sql.text("d + 5"),
        "read_back": sql.number("d"),
    },
)
SEARCH_WINDOW = _select(
    {f"{p}_{side}": lambda d, p=p, i=i: dates.search_window(p, d)[i]
     for p in ("year", "month", "week", "day") for i, side in enumerate(("low", "high"))},
    {f"{p}_{side}": sql.number(sql.shifted(p, "d") if side == "low" else "d")
     for p in ("year", "month", "week", "day") for side in ("low", "high")},
)
BACKFILL_RANGE = _select(
    {
        "first_day": lambda d: dates.day_number(dates.backfill_range(d, 1)[0]),
        "end_day": lambda d: dates.day_number(dates.backfill_range(d, 1)[1]),
    },
    {
        "first_day": sql.number(sql.months_back(sql.business_days_back("d", 4), 2)),
        "end_day": sql.number(sql.months_back(sql.business_days_back("d", 4), -1)),
    },
)


def date_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each calendar day from the first to the last order day, with its orders."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    span = orders.agg(F.min("d").alias("first"), F.max("d").alias("last"))
    end = dates.days_forward(F.col("last"), 1)
    calendar = span.select(F.explode(dates.day_series(F.col("first"), end)).alias("d"))
    counts = orders.groupBy("d").agg(F.count("*").alias("n"))
    return calendar.join(counts, "d", "left").select(
        dates.day_number(F.col("d")).alias("date"), F.coalesce("n", F.lit(0)).alias("orders")
    )


DATE_SERIES = """SELECT cast(strftime(g.t, '%Y%m%d') AS integer) AS date,
    coalesce(c.n, 0) AS orders
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day))
        AS t FROM orders) g
    LEFT JOIN (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY 1) c
        ON c.o_orderdate = g.t"""

QUERIES = {
    "date_anchors": DATE_ANCHORS,
    "previous_dates": PREVIOUS_DATES,
    "weekday_backdate": WEEKDAY_BACKDATE,
    "business_days_back": BUSINESS_DAYS_BACK,
    "month_overflow": MONTH_OVERFLOW,
    "date_strings": DATE_STRINGS,
    "search_window": SEARCH_WINDOW,
    "backfill_range": BACKFILL_RANGE,
    "date_series": (date_series, DATE_SERIES),
}
