"""Records sent in bounded requests, once each."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.sinks import requests


def test_requests_are_bounded():
    records = [(f"k{i}", "x" * (i % 7)) for i in range(100)] + [(None, "é" * 20)]
    packed = list(requests.packed_requests(iter(records), 8, 40))
    assert [(r["key"], r["value"]) for request in packed for r in request] == records
    sizes = [sum(len((r["key"] or "").encode()) + len(r["value"].encode()) for r in q) for q in packed]
    assert max(len(q) for q in packed) <= 8 and max(sizes) <= 40 and len(packed) > 12
    assert list(requests.packed_requests(iter([]), 8, 40)) == []
    with pytest.raises(ValueError, match="does not fit"):
        list(requests.packed_requests(iter([("a", "x" * 50)]), 8, 40))


def sent(spark, path):
    rows = requests.read_requests(spark, path).select("request", F.size("records").alias("n"), F.explode("records").alias("r"))
    return [(r.r.key, json.loads(r.r.value)["v"], r.n) for r in rows.collect()]


def test_batch(spark, tmp_path):
    path = str(tmp_path / "sink")
    df = spark.range(1201).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    assert requests.send_records(df.repartition(2), "k", path) is None
    got = sent(spark, path)
    assert sorted(v for _, v, _ in got) == list(range(1201)) and all(k == str(v) for k, v, _ in got)
    assert max(n for _, _, n in got) <= 500
    requests.send_records(df.limit(3), "k", path, mostRecords="2")
    assert len(sent(spark, path)) == 1204


def test_a_replayed_epoch_counts_once(spark, tmp_path):
    source, path, progress = (str(tmp_path / n) for n in ("in", "sink", "progress"))
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    df.write.parquet(source)
    stream = lambda: spark.readStream.schema(df.schema).parquet(source)
    requests.send_records(stream(), "k", path, progress).awaitTermination()
    assert sorted(v for _, v, _ in sent(spark, path)) == list(range(50))
    # Spark's note of the last epoch is lost: it is written again.
    notes = [p for p in Path(progress, "commits").iterdir() if p.name.lstrip(".").split(".")[0].isdigit()]
    for note in notes:
        note.unlink()
    requests.send_records(stream(), "k", path, progress).awaitTermination()
    assert sorted(v for _, v, _ in sent(spark, path)) == list(range(50))
    files = {p.name for p in Path(path, "requests").glob("*.jsonl")}
    listed = {
        json.loads(line)["name"].split("/")[1]
        for p in Path(path, "epochs").glob("*.json") for line in p.read_text().splitlines()
    }
    assert files == listed
    spark.createDataFrame([("50", 50)], "k string, v long").write.mode("append").parquet(source)
    requests.send_records(stream(), "k", path, progress).awaitTermination()
    assert sorted(v for _, v, _ in sent(spark, path)) == list(range(51))


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "sink")
    df = spark.createDataFrame([("a", "x"), ("b", "y" * 100)], "k string, v string").repartition(2)
    with pytest.raises(Exception, match="does not fit"):
        requests.send_records(df, "k", path, mostBytes="40")
    assert not list(Path(path).glob("epochs/*"))
