"""Keyed tables in buckets."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.sinks import buckets

SCHEMA = "code string, date int, percent double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def file_times(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "table")
    assert buckets.read_buckets(spark, root) is None
    assert buckets.rows_of_key(spark, root, code="a", date=1) is None
    maker = random.Random(5)
    table = {(f"C{n % 40}", n // 40): float(n) for n in range(400)} | {(None, 3): 1.0}
    keys = ["code", "date"]
    rows = [(*k, v) for k, v in table.items()]
    assert buckets.upsert_buckets(frame(spark, rows), root, keys, 16) == list(range(16))
    for turn in range(3):
        before = file_times(root)
        change = {(f"C{maker.randrange(60)}", maker.randrange(12)): float(turn) for _ in range(3)}
        change[None, 3] = 10.0 + turn
        touched = buckets.upsert_buckets(
            frame(spark, [(*k, v) for k, v in change.items()]), root, keys, 99
        )
        table |= change
        assert buckets.buckets_of_table(spark, root) == 16 and len(touched) <= 4
        after = file_times(root)
        kept = {p: t for p, t in before.items() if int(p.split("bucket=")[1].split("/")[0]) not in touched}
        assert kept and kept.items() <= after.items()
        changed = {p for p in after if p not in before or after[p] != before[p]}
        assert {int(p.split("bucket=")[1].split("/")[0]) for p in changed} == set(touched)
        got = {(r.code, r.date): r.percent for r in buckets.read_buckets(spark, root).collect()}
        assert got == table
    assert buckets.upsert_buckets(frame(spark, []), root, keys) == []


def test_lookups_read_one_bucket(spark, tmp_path, plan_of):
    root = str(tmp_path / "table")
    rows = [(f"C{n}", n % 5, float(n)) for n in range(2000)]
    buckets.upsert_buckets(frame(spark, rows), root, ["code"], 32)
    found = buckets.rows_of_key(spark, root, code="C77")
    assert [tuple(r) for r in found.collect()] == [("C77", 2, 77.0)]
    plan = plan_of(found)
    assert "PartitionFilters" in plan and "EqualTo(code,C77)" in plan
    assert buckets.rows_of_key(spark, root, code="missing").collect() == []
    read = {r.f for r in found.select(F.input_file_name().alias("f")).collect()}
    assert len(read) == 1


def test_keys_of_any_type_and_new_columns(spark, tmp_path):
    root = str(tmp_path / "table")
    buckets.upsert_buckets(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), root, ["k"], 4)
    more = spark.createDataFrame([(2, "c", 1.5), (3, "d", 2.5)], "k bigint, v string, w double")
    buckets.upsert_buckets(more, root, ["k"])
    got = sorted(tuple(r) for r in buckets.read_buckets(spark, root).select("k", "v", "w").collect())
    assert got == [(1, "a", None), (2, "c", 1.5), (3, "d", 2.5)]
    assert [r.v for r in buckets.rows_of_key(spark, root, k=2).collect()] == ["c"]
    assert [r.v for r in buckets.rows_of_key(spark, root, k="2").collect()] == ["c"]


@pytest.mark.parametrize("value", ["C5", None])
def test_missing_and_null_keys(spark, tmp_path, value):
    root = str(tmp_path / "table")
    buckets.upsert_buckets(frame(spark, [("C5", 1, 1.0), (None, 2, 2.0)]), root, ["code"], 8)
    found = [r.code for r in buckets.rows_of_key(spark, root, code=value).collect()]
    assert found == [value]
