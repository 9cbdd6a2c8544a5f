import datetime as dt
import random

from pyspark.sql import functions as F

from ebbtide.operators.dedup import last_wins
from ebbtide.operators.merge import merge_day, merge_days
from ebbtide.plans import normalise
from tests.test_sources import put, report

CODES = "code string, name string, industry string"
POSITIONS = "code string, date int, shorts bigint, total bigint, percent double"
FIELDS = ("date", "code", "shorts", "total", "percent")


def test_match_and_no_match(spark, rows_of):
    maker = random.Random(15)
    listed = [(f"L{n}", f"firm {n}", maker.choice(["Rail", "Ore"])) for n in range(12)]
    held = {
        f"L{n}": (maker.randint(1, 99), maker.randint(100, 999), n / 4) for n in range(5, 16)
    }
    codes = spark.createDataFrame(listed, CODES)
    positions = spark.createDataFrame(
        [(code, 20190517, *values) for code, values in held.items()], POSITIONS
    )
    expected = sorted(
        (20190517, code, name, *held.get(code, (0, 0, 0.0)), industry)
        for code, name, industry in listed
    )
    assert rows_of(merge_days(codes, positions, positions.select("date"))) == expected
    assert rows_of(merge_day(codes, positions, 20190517)) == expected


def test_days_without_positions_are_zero_and_other_days_absent(spark, rows_of):
    codes = spark.createDataFrame([("A", "a", "x"), ("B", "b", "y")], CODES)
    positions = spark.createDataFrame([("A", 20181001, 1, 2, 3.0)], POSITIONS)
    days = spark.createDataFrame([(20181001,), (20181003,), (20181003,)], "date int")
    assert rows_of(merge_days(codes, positions, days), *FIELDS) == [
        (20181001, "A", 1, 2, 3.0),
        (20181001, "B", 0, 0, 0.0),
        (20181003, "A", 0, 0, 0.0),
        (20181003, "B", 0, 0, 0.0),
    ]
    none = days.limit(0)
    assert merge_days(codes, positions.limit(0), none).count() == 0


def test_dedup_and_merge_match_brute_force(spark, rows_of):
    rng = random.Random(3)
    codes = [f"C{i}" for i in range(40)]
    raw = []
    for n in range(3000):
        code = "C7" if rng.random() < 0.35 else f"C{rng.randrange(60)}"
        raw.append((code, 20181001 + rng.randrange(15), n, rng.randrange(9), n / 8, n % 7, n))
    rng.shuffle(raw)
    schema = POSITIONS + ", minor int, seq bigint"
    df = spark.createDataFrame(raw, schema).repartition(16)
    values = ("shorts", "total", "percent")

    def newest(order):
        best = {}
        for row in raw:
            if (row[0], row[1]) not in best or order(row) > order(best[row[0], row[1]]):
                best[row[0], row[1]] = row
        return best

    single = last_wins(df, ["code", "date"], ["seq"], values)
    best = newest(lambda r: r[6])
    assert rows_of(single, *FIELDS) == sorted(
        (d, c, *row[2:5]) for (c, d), row in best.items()
    )
    double = last_wins(df, ["code", "date"], ["minor", "seq"], values)
    best = newest(lambda r: (r[5], r[6]))
    assert rows_of(double, *FIELDS) == sorted(
        (d, c, *row[2:5]) for (c, d), row in best.items()
    )
    listed = spark.createDataFrame([(c, c.lower(), "i") for c in codes], CODES)
    days = sorted({d for _, d in best})
    merged = merge_days(listed, double, df.select("date"))
    assert rows_of(merged, *FIELDS) == sorted(
        (d, c, *(best[c, d][2:5] if (c, d) in best else (0, 0, 0.0)))
        for c in codes
        for d in days
    )


def folder(tmp_path):
    put(tmp_path / "codes.csv", "one,AAA,Energy\ntwo,BBB,Food\nnewer two,BBB,Drink\n")
    landing = tmp_path / "landing"
    report(landing, "20181001", "x\tAAA \t1\t10\t0.5\nx\tZZZ\t9\t9\t9\n")
    report(landing, "20181002", "")
    report(landing, "20181003", "<html>not found</html>\n")
    report(landing, "20181005", "x\tBBB\t5\t50\t1.5\nx\tBBB\t6\t60\t2.5\n")
    return str(tmp_path / "codes.csv"), str(landing)


def test_a_folder_of_days(spark, tmp_path, rows_of):
    listing, landing = folder(tmp_path)
    rows = normalise.normalise_folder(spark, listing, landing)
    assert rows_of(rows, "date", "code", "name", "shorts", "percent", "industry") == [
        (20181001, "AAA", "one", 1, 0.5, "Energy"),
        (20181001, "BBB", "newer two", 0, 0.0, "Drink"),
        (20181002, "AAA", "one", 0, 0.0, "Energy"),
        (20181002, "BBB", "newer two", 0, 0.0, "Drink"),
        (20181003, "AAA", "one", 0, 0.0, "Energy"),
        (20181003, "BBB", "newer two", 0, 0.0, "Drink"),
        (20181005, "AAA", "one", 0, 0.0, "Energy"),
        (20181005, "BBB", "newer two", 6, 2.5, "Drink"),
    ]
    some = normalise.normalise_folder(
        spark, listing, landing, dt.date(2018, 10, 2), dt.date(2018, 10, 5)
    )
    assert {r["date"] for r in some.collect()} == {20181002, 20181003}
    assert normalise.last_day(rows).first()["date"] == 20181005


def test_one_day_of_a_folder(spark, tmp_path, rows_of):
    listing, landing = folder(tmp_path)
    day = normalise.normalise_day(spark, listing, landing, "20181005")
    assert rows_of(day, "date", "code", "shorts") == [(20181005, "AAA", 0), (20181005, "BBB", 6)]
    empty = normalise.normalise_day(spark, listing, landing, "20181002")
    assert rows_of(empty, "code", "shorts") == [("AAA", 0), ("BBB", 0)]
    assert normalise.normalise_day(spark, listing, landing, "20181004") is None


def test_merge_shuffles_neither_names_per_day_nor_a_grid(spark, plan_of):
    codes = spark.createDataFrame([("A", "a", "x")], CODES)
    positions = spark.createDataFrame([("A", 20181001, 1, 2, 3.0)], POSITIONS)
    plan = plan_of(merge_days(codes, positions, positions.select("date")))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    day = normalise.between_days(positions, dt.date(2018, 10, 1), F.lit("2018-10-02").cast("date"))
    assert day.count() == 1

