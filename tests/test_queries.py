import datetime as dt
import random
import json
import re

import pytest

from ebbtide.operators import lookup
from ebbtide.plans import queries
from ebbtide.sinks.days import write_days

CODES = ("DayCode", "WeekCode", "MonthCode", "YearCode")
CHANGES = ("DayChange", "WeekChange", "MonthChange", "YearChange")
MOVER = "Position int, " + ", ".join(
    [f"{c} string" for c in CODES] + [f"{c} double" for c in CHANGES]
)
AS_OF = dt.date(2018, 10, 9)


@pytest.mark.parametrize(("text", "count"), [(None, 10), ("1", 1), ("10", 10), ("100", 100)])
def test_row_counts(text, count):
    assert queries.row_count(text) == count


@pytest.mark.parametrize("text", ["101", "0", "-1", "ten", ""])
def test_row_counts_out_of_bounds(text):
    with pytest.raises(ValueError):
        queries.row_count(text)


def test_row_counts_of_series_have_no_upper_bound():
    assert queries.row_count("101", most=None) == 101
    with pytest.raises(ValueError):
        queries.row_count("0", most=None)


def test_top_shorts_in_order(spark):
    places = list(range(40))
    random.Random(5).shuffle(places)
    ranked = spark.createDataFrame(
        [(n, f"Q{n}", 90.0 - n) for n in places], "Position bigint, Code string, Percent float"
    )
    rows = queries.top_shorts(ranked, 12).collect()
    assert [(r["position"], r["code"]) for r in rows] == [(n, f"Q{n}") for n in range(12)]
    assert len(queries.top_shorts(ranked, 50).collect()) == 40


def test_stored_floats_and_unreadable_numbers(spark):
    ranked = spark.createDataFrame(
        [("0", "A", "0.1"), ("1", "B", "x"), ("x", "C", "1")],
        "Position string, Code string, Percent string",
    )
    rows = queries.top_shorts(ranked, 5).collect()
    assert [(r["position"], r["code"], round(r["percent"], 6)) for r in rows] == [
        (0, "A", 0.1),
        (1, "B", 0.0),
    ]
    series = spark.createDataFrame(
        [("BBB", 20181009, 0.1)], "Code string, Date int, Percent float"
    )
    point = queries.series_points(ranked_table(spark), series, 1, "week", AS_OF).first()
    assert point["Percent"] == 0.1


def movers_table(spark):
    full = [(n, f"D{n}", f"W{n}", f"M{n}", f"Y{n}", 0.1, 0.2, 0.3, n / 1.0) for n in range(1, 8)]
    full[1] = (*full[1][:4], None, *full[1][5:])
    full[2] = (*full[2][:6], None, *full[2][7:])
    return spark.createDataFrame(full, MOVER)


def test_top_movers(spark):
    rows = queries.top_movers(movers_table(spark), 5).collect()
    # The third row's unreadable number takes all its numbers, the rank included.
    assert [r["order"] for r in rows] == [0, 1, 2, 4]
    by_code = {r["weekCode"]: r for r in rows}
    assert by_code["W1"]["yearCode"] == "Y1" and by_code["W1"]["weekChange"] == 0.2
    assert by_code[""]["order"] == 2 and by_code[""]["yearChange"] == 2.0
    bad = by_code["W3"]
    assert (bad["order"], bad["dayChange"], bad["yearChange"]) == (0, 0.0, 0.0)
    assert queries.top_movers(movers_table(spark), 5, exact_count=True).count() == 5


def test_top_movers_of_a_table_without_a_column(spark):
    rows = queries.top_movers(movers_table(spark).drop("YearCode"), 3).collect()
    assert [r["order"] for r in rows] == [1, 2]
    assert {r["dayCode"] for r in rows} == {""}


def test_coded_movers(spark):
    text = "Code string, " + ", ".join(f"{c} string" for c in CHANGES)
    maker = random.Random(6)
    whole = {f"K{n}": [maker.randint(-80, 80) / 16 for _ in CHANGES] for n in range(9)}
    rows = [(code, *map(str, values)) for code, values in whole.items()]
    rows[3] = (*rows[3][:3], "n/a", *rows[3][4:])
    rows[5] = (rows[5][0], None, *rows[5][2:])
    coded = spark.createDataFrame(rows, text)
    for n, (code, values) in enumerate(whole.items()):
        found = [tuple(r) for r in queries.coded_movers(coded, code).collect()]
        assert found == ([] if n in (3, 5) else [(code, *values)])
    assert queries.coded_movers(coded, "missing").collect() == []
    assert queries.coded_movers(coded.drop("YearChange"), "K1").collect() == []


def series_table(spark, tmp_path):
    rows = [
        (code, day, float(day % 100))
        for code in ("AAA", "BBB", "CCC")
        for day in (20170101, 20180908, 20180910, 20181001, 20181003, 20181009, 20181010)
        if (code, day) != ("BBB", 20181003)
    ]
    df = spark.createDataFrame(rows, "Code string, Date int, Percent double")
    write_days(df, str(tmp_path / "series"), by="Date", sort="Code")
    return spark.read.parquet(str(tmp_path / "series"))


def ranked_table(spark):
    rows = [(0, "BBB", 3.0), (1, "NONE", 2.0), (2, "AAA", 1.0), (3, "CCC", 0.5)]
    return spark.createDataFrame(rows, "Position bigint, Code string, Percent double")


def test_top_series(spark, tmp_path):
    series, ranked = series_table(spark, tmp_path), ranked_table(spark)
    found = {
        r["Code"]: [tuple(p) for p in r["series"]]
        for r in queries.top_series(ranked, series, 3, "month", AS_OF).collect()
    }
    dates = (20180910, 20181001, 20181003, 20181009)
    assert found == {
        "AAA": [(d, float(d % 100)) for d in dates],
        "BBB": [(d, float(d % 100)) for d in dates if d != 20181003],
        "NONE": [],
    }
    week = queries.top_series(ranked, series, 1, "week", AS_OF).collect()
    assert [[p["Date"] for p in r["series"]] for r in week] == [[20181009]]
    assert queries.top_series(ranked, series, 50, "year", AS_OF).count() == 4
    with pytest.raises(ValueError):
        queries.top_series(ranked, series, 3, "latest", AS_OF)


def test_unreadable_points(spark):
    series = spark.createDataFrame(
        [("BBB", "20181008", "0.5"), ("BBB", "20181009", "x"), ("BBB", "2018100x", "1")],
        "Code string, Date string, Percent string",
    )
    row = queries.top_series(ranked_table(spark), series, 1, "week", AS_OF).first()
    assert [tuple(p) for p in row["series"]] == [(20181008, 0.5), (20181009, 0.0)]


def test_series_as_json(spark, tmp_path):
    per_code = queries.top_series(
        ranked_table(spark), series_table(spark, tmp_path), 2, "week", AS_OF
    )
    answer = queries.series_json(per_code).first()["json"]
    assert json.loads(answer) == {"BBB": [{"Date": 20181009, "Percent": 9.0}], "NONE": []}


def test_rows_as_json(spark):
    answer = queries.as_json(queries.top_shorts(ranked_table(spark), 1)).first()["json"]
    assert json.loads(answer) == {"position": 0, "code": "BBB", "percent": 3.0}
    whole = queries.answer_json(queries.top_shorts(ranked_table(spark).repartition(4), 3))
    assert [row["code"] for row in json.loads(whole.first()["json"])] == ["BBB", "NONE", "AAA"]


def test_lookups(spark, tmp_path, rows_of, plan_of):
    series = series_table(spark, tmp_path)
    assert rows_of(lookup.by_key(ranked_table(spark), "Code", "AAA")) == [(2, "AAA", 1.0)]
    assert rows_of(lookup.by_key(ranked_table(spark), "Code", "zzz")) == []
    one = lookup.by_key_and_sort(series, "Code", "AAA", "Date", 20181003)
    assert rows_of(one, "Code", "Date") == [("AAA", 20181003)]
    span = lookup.in_range(series, "Code", "AAA", "Date", 20180910, 20181009)
    assert [r["Date"] for r in span.collect()] == [20180910, 20181001, 20181003, 20181009]
    plan = plan_of(span)
    assert "PartitionFilters: [isnotnull(Date" in plan and "EqualTo(Code,AAA)" in plan
    assert {r["Date"] for r in lookup.after(series, "Date", 20181003).collect()} == {
        20181009,
        20181010,
    }


def test_batch_lookup(spark, rows_of):
    ranked = ranked_table(spark)
    expected = [(0, "BBB", 3.0), (2, "AAA", 1.0)]
    assert rows_of(lookup.by_keys(ranked, "Code", ["AAA", "BBB", "none"])) == expected
    many = ["AAA", "BBB"] + [f"x{i}" for i in range(lookup.IN_LIST_KEYS)]
    assert rows_of(lookup.by_keys(ranked, "Code", many)) == expected
    keys = spark.createDataFrame([("AAA",), ("BBB",), ("AAA",)], "Code string")
    assert rows_of(lookup.by_keys(ranked, "Code", keys)) == expected
    assert rows_of(lookup.by_keys(ranked, "Position", range(2)), "Code") == [("BBB",), ("NONE",)]


def test_the_series_side_is_not_shuffled_raw(spark, tmp_path, plan_of):
    plan = plan_of(
        queries.series_points(ranked_table(spark), series_table(spark, tmp_path), 3, "week", AS_OF)
    )
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert re.search(r"PartitionFilters: \[.*Date#\d+ >= 20181002", plan)
