import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import dates

# A Saturday; its anchors are worked out below with the standard library alone.
BASE = dt.date(2021, 3, 27)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def number(day):
    return int(day.strftime("%Y%m%d"))


def to_friday(day):
    return day - dt.timedelta(max(0, day.weekday() - 4))


STEPS = [
    dt.date(2020, 3, 27),
    dt.date(2021, 2, 27),
    dt.date(2021, 3, 20),
    dt.date(2021, 3, 26),
    BASE,
]


@pytest.mark.parametrize("option", range(len(STEPS)))
def test_anchors(spark, option):
    found = value(spark, dates.previous_day_number(option, BASE))
    assert found == number(STEPS[option])
    found = value(spark, dates.previous_weekday_number(option, BASE))
    assert found == number(to_friday(STEPS[option]))


def test_unknown_anchors_are_zero(spark):
    assert value(spark, dates.previous_weekday_number(7, BASE)) == 0
    assert value(spark, dates.previous_day_number(9, BASE)) == 0


def test_back_and_forward(spark):
    day = dates.as_day(BASE)
    found = spark.range(1).select(
        dates.day_text(dates.days_back(day, 30)),
        dates.day_text(dates.months_back(day, 3)),
        dates.day_text(dates.years_back(day, 2)),
        dates.day_text(dates.days_forward(day, 5)),
    ).first()
    assert tuple(found) == ("20210225", "20201227", "20190327", "20210401")


@pytest.mark.parametrize(
    ("day", "months", "expected"),
    [
        (dt.date(2018, 3, 31), 1, 20180303),
        (dt.date(2020, 2, 29), 12, 20190301),
        (dt.date(2018, 5, 31), 3, 20180303),
        (dt.date(2018, 1, 31), -1, 20180303),
        (dt.date(2018, 10, 7), 0, 20181007),
    ],
)
def test_a_missing_day_spills_into_the_next_month(spark, day, months, expected):
    assert value(spark, dates.day_number(dates.months_back(day, months))) == expected


def step_back(day, count):
    while count > 0:
        if day.weekday() < 5:
            count -= 1
        day -= dt.timedelta(days=1)
    return day


def test_business_days_match_stepping(spark):
    days = [dt.date(2018, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    cases = [(day, count) for day in days for count in range(12)]
    df = spark.createDataFrame(cases, "day date, count int").select(
        "day", "count", dates.business_days_back(F.col("day"), F.col("count")).alias("back")
    )
    for day, count, back in df.collect():
        assert back == step_back(day, count), (day, count)


def test_numbers_and_days_convert_both_ways(spark):
    rng = random.Random(5)
    days = [dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(20000)) for _ in range(200)]
    df = spark.createDataFrame([(day,) for day in days], "day date").select(
        "day", dates.day_number(F.col("day")).alias("n")
    )
    df = df.withColumn("again", dates.number_to_day(F.col("n")))
    for day, number, again in df.collect():
        assert number == int(f"{day:%Y%m%d}") and again == day
    assert value(spark, dates.number_to_day(F.lit("20180231"))) is None


@pytest.mark.parametrize(
    ("text", "period", "series_period"),
    [
        ("day", "day", "week"),
        ("WEEK", "week", "week"),
        ("Month", "month", "month"),
        ("yEaR", "year", "year"),
        ("decade", "week", "week"),
        (None, "week", "week"),
    ],
)
def test_period_names(text, period, series_period):
    assert dates.period_name(text) == period
    assert dates.series_period_name(text) == series_period


def test_search_window(spark):
    def window(*args):
        low, high = dates.search_window(*args)
        return tuple(spark.range(1).select(low, high).first())

    assert window("week", BASE) == (number(STEPS[2]), number(BASE))
    assert window("year", BASE) == (number(STEPS[0]), number(BASE))
    assert window("latest", BASE, "2021-01-30T08:15:00+00:00") == (20210130, number(BASE))
    assert window("latest", BASE, "2021-01-30T22:15:00-04:00") == (20210131, number(BASE))
    assert window("latest", BASE, "noon") == (-1, -1)
    assert window("latest", BASE, None) == (-1, -1)
    with pytest.raises(ValueError):
        dates.search_window("decade", BASE)


def test_day_series_leaves_out_its_end(spark):
    series = value(spark, dates.day_series(dt.date(2018, 2, 27), dt.date(2018, 3, 2)))
    assert series == [dt.date(2018, 2, 27), dt.date(2018, 2, 28), dt.date(2018, 3, 1)]
    assert value(spark, dates.day_series(BASE, BASE)) == []


def test_backfill_range_moves_both_bounds(spark):
    start, end = dates.backfill_range(dt.date(2018, 10, 12), 1)
    found = spark.range(1).select(dates.day_number(start), dates.day_number(end)).first()
    # Friday less four business days is Monday 8 October.
    assert tuple(found) == (20180808, 20181108)


def test_literal_days_fold_to_literals(spark, plan_of):
    df = spark.range(5).where(F.col("id") == dates.anchor_numbers(BASE)["month"])
    assert str(number(to_friday(STEPS[1]))) in plan_of(df, "simple")
