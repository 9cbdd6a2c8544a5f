import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.numbers import NO_BASELINE
from ebbtide.operators.rank import all_ranked, first_ranked, ranked_within
from ebbtide.plans import movers, rankings

TUESDAY = dt.date(2018, 10, 9)
ANCHORS = {
    "latest": 20181009,
    "day": 20181008,
    "week": 20181002,
    "month": 20180907,
    "year": 20171009,
}
SNAPSHOT = "code string, date int, percent double"


def test_full_ranking_with_mostly_equal_values(spark):
    rng = random.Random(9)
    rows = [(f"C{i:05}", 0.0 if rng.random() < 0.7 else rng.randrange(40) / 4) for i in range(5000)]
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    df = spark.createDataFrame(rows, "code string, percent double").repartition(13)
    ranked = rankings.ranked_codes(df)
    found = sorted(ranked.collect(), key=lambda r: r["Position"])
    assert [(r["Code"], r["Percent"]) for r in found] == expected
    assert [r["Position"] for r in found] == list(range(5000))
    leading = rankings.leading_codes(df, 100).orderBy("Position").collect()
    assert [(r["Position"], r["Code"]) for r in leading] == [
        (i, code) for i, (code, _) in enumerate(expected[:100])
    ]


def test_full_ranking_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        code = F.col("id").cast("string").alias("code")
        df = spark.range(4000).select(F.lit(0.0).alias("percent"), code)
        ranked = all_ranked(df, [F.desc("percent"), F.asc("code")], "n")
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 1000


def test_ranks_within_groups(spark):
    rng = random.Random(12)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(5), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(9)
    found = ranked_within(df, "g", [F.desc("v"), F.asc("i")], "n")
    assert found.columns == ["g", "v", "i", "n"]
    expected = []
    for group in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
        expected += [(*r, n) for n, r in enumerate(own)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("largest_first", [False, True])
def test_more_ranks_than_a_window_cuts(spark, plan_of, largest_first):
    rng = random.Random(13)
    wide = [
        (f"C{i:05}", *[None if rng.random() < 0.1 else rng.randrange(-300, 300) / 4 for _ in range(4)])
        for i in range(2500)
    ]
    schema = "code string, day double, week double, month double, year double"
    df = spark.createDataFrame(wide, schema).repartition(7)
    deep = movers.ordered_changes(df, 2200, largest_first)
    assert "WindowGroupLimit" not in plan_of(deep)
    sign = -1 if largest_first else 1

    def ranked(n):
        own = sorted(wide, key=lambda r: (r[n] is None, sign * abs(r[n] or 0), r[0]))
        return [(r[0], NO_BASELINE if r[n] is None else r[n]) for r in own[:2200]]

    sides = [ranked(n) for n in range(1, 5)]
    expected = [(i + 1, *[v for side in sides for v in side[i]]) for i in range(2200)]
    assert [tuple(r) for r in deep.collect()] == expected
    few = movers.ordered_changes(df, 50, largest_first).collect()
    assert [tuple(r) for r in few] == expected[:50]


def test_many_ranks_meet_in_no_single_task(spark):
    """5,000 ranks over a million codes: no task holds a horizon."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wide = spark.range(1_000_000, numPartitions=8).select(
            F.col("id").cast("string").alias("code"),
            *[F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1000)).cast("double").alias(h)
              for n, h in enumerate(movers.HORIZONS)],
        )
        changed = wide.unpivot(["code"], list(movers.HORIZONS), "horizon", "change")
        ranked = ranked_within(changed, "horizon", [F.asc("change"), F.asc("code")], "n")
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
        deep = movers.ordered_changes(wide, 5000)
        assert deep.count() == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 700_000


def test_rankings_of_nothing(spark):
    df = spark.createDataFrame([], "code string, percent double")
    order = [F.desc("percent"), F.asc("code")]
    assert all_ranked(df, order, "n").count() == 0
    assert first_ranked(df, order, 10, "n").count() == 0


def test_top_k_keeps_few_rows_per_task(spark, plan_of):
    df = spark.range(1000).selectExpr("string(id) AS code", "double(id) AS percent")
    assert "TakeOrderedAndProject" in plan_of(rankings.leading_codes(df, 10))


def snapshot_rows(seed, codes=250):
    """Random percentages; some codes lack some days."""
    rng = random.Random(seed)
    rows = []
    for i in range(codes):
        for day in [*ANCHORS.values(), 20181005]:
            if rng.random() < 0.8:
                rows.append((f"C{i:03}", day, rng.randrange(64) / 8))
    return rows


def brute_changes(rows):
    percent = {(c, d): p for c, d, p in rows}
    out = {}
    for code in sorted({c for c, d, _ in rows if d == ANCHORS["latest"]}):
        latest = percent[code, ANCHORS["latest"]]
        out[code] = [
            latest - percent[code, ANCHORS[h]] if (code, ANCHORS[h]) in percent else None
            for h in ("day", "week", "month", "year")
        ]
    return out


def brute_ordered(changes, largest=False):
    legs = []
    for i in range(4):
        def key(code, i=i):
            change = changes[code][i]
            size = 0.0 if change is None else abs(change)
            return (change is None, -size if largest else size, code)

        legs.append(sorted(changes, key=key)[:99])
    rows = []
    for n in range(len(legs[0])):
        row = [n + 1]
        for i in range(4):
            code = legs[i][n]
            change = changes[code][i]
            row += [code, NO_BASELINE if change is None else change]
        rows.append(tuple(row))
    return rows


@pytest.mark.parametrize("largest", [False, True])
@pytest.mark.parametrize("codes", [40, 250])
def test_ordered_movers(spark, rows_of, largest, codes):
    rows = snapshot_rows(codes, codes)
    df = spark.createDataFrame(rows, SNAPSHOT).repartition(7)
    ordered = movers.ordered_movers(df, TUESDAY, largest_first=largest)
    assert ordered.columns == movers.ORDERED_COLUMNS
    assert [tuple(r) for r in ordered.collect()] == brute_ordered(brute_changes(rows), largest)


def test_coded_movers(spark, rows_of):
    rows = snapshot_rows(4)
    df = spark.createDataFrame(rows, SNAPSHOT)
    expected = [
        (code, *[NO_BASELINE if c is None else c for c in changes])
        for code, changes in sorted(brute_changes(rows).items())
    ]
    assert rows_of(movers.coded_movers(df, TUESDAY)) == expected


def test_anchors_that_fall_on_one_day(spark, rows_of):
    # Seen from a Sunday both the latest day and the day before are Friday.
    df = spark.createDataFrame([("A", 20181005, 2.0), ("A", 20180928, 0.5)], SNAPSHOT)
    coded = movers.coded_movers(df, dt.date(2018, 10, 7))
    assert rows_of(coded) == [("A", 0.0, 1.5, NO_BASELINE, NO_BASELINE)]


def test_a_percentage_kept_as_float(spark, rows_of):
    rows = [("A", 20181009, 0.3), ("A", 20181008, 0.1), ("B", 20181009, None)]
    df = spark.createDataFrame(rows, "code string, date int, percent float")
    assert rows_of(movers.coded_movers(df, TUESDAY), "Code", "DayChange") == [
        ("A", 0.3 - 0.1),
        ("B", NO_BASELINE),
    ]


def test_movers_read_the_snapshots_once(spark, tmp_path, plan_of):
    df = spark.createDataFrame(snapshot_rows(1), SNAPSHOT)
    df.write.partitionBy("date").parquet(str(tmp_path / "days"))
    stored = spark.read.parquet(str(tmp_path / "days"))
    plan = plan_of(movers.ordered_movers(stored, TUESDAY))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in its details
    assert "PartitionFilters: [date" in plan
    assert "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<code:string,percent:double>" in plan


def test_views_and_sql(spark, rows_of):
    rows = snapshot_rows(2)
    views = movers.create_anchor_views(spark.createDataFrame(rows, SNAPSHOT), TUESDAY)
    assert set(views) == set(ANCHORS)
    found = movers.run_sql(
        spark,
        """SELECT latest.code, latest.percent - month.percent AS change
        FROM latest LEFT JOIN month ON latest.code = month.code""",
    )
    expected = sorted((c, ch[2]) for c, ch in brute_changes(rows).items())
    key = [(c, ch is None, ch) for c, ch in expected]
    assert sorted((r[0], r[1] is None, r[1]) for r in found.collect()) == key
    assert movers.run_sql(spark, "SELECT DISTINCT dateTime FROM month").first()[0] == "20180907"


ORDERED_TEXT = ", ".join(f"{name} string" for name in movers.ORDERED_COLUMNS)
CODED_TEXT = ", ".join(f"{name} string" for name in movers.CODED_COLUMNS)


def number(text):
    """What a change reads as: missing is zero, anything but a number is None."""
    if text is None:
        return 0.0
    try:
        return float(text)
    except ValueError:
        return None


def broken(maker, rows):
    """Rows with some slots missing or unreadable."""
    harmed = []
    for row in rows:
        row = list(row)
        for _ in range(maker.choice([0, 0, 1, 2])):
            row[maker.randrange(len(row))] = maker.choice([None, None, "?", "4,5"])
        harmed.append(tuple(row))
    return harmed


def test_decoding_ordered_rows(spark, rows_of):
    maker = random.Random(77)
    whole = [
        (str(n), *(x for h in "pqrs" for x in (f"{h.upper()}{n}", f"{maker.uniform(-9, 9):.3f}")))
        for n in range(1, 120)
    ]
    rows = broken(maker, whole)
    wanted = []
    for row in rows:
        changes = [number(text) for text in row[2::2]]
        rank = row[0] if row[0] and row[0].isdigit() else None
        if rank and None not in changes and None not in row[1::2]:
            pairs = (x for pair in zip(row[1::2], changes, strict=True) for x in pair)
            wanted.append((int(rank), *pairs))
    assert 20 < len(wanted) < 110
    decoded = movers.decode_ordered(spark.createDataFrame(rows, ORDERED_TEXT))
    assert rows_of(decoded) == sorted(wanted)


def test_decoding_coded_rows(spark, rows_of):
    maker = random.Random(78)
    whole = [
        (f"C{n:03}", *(f"{maker.uniform(-9, 9):.3f}" for _ in range(4))) for n in range(120)
    ]
    rows = broken(maker, whole) + [("EMPTY", "", "1", "1", "1")]
    wanted = [
        (row[0], *map(number, row[1:]))
        for row in rows
        if row[0] is not None and None not in map(number, row[1:])
    ]
    decoded = movers.decode_coded(spark.createDataFrame(rows, CODED_TEXT))
    assert rows_of(decoded) == sorted(wanted)
