import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ebbtide.plans import jobs, movers
from ebbtide.schemas import SNAPSHOT_ROW
from ebbtide.session import materialise, scratch_path, shared_folder
from ebbtide.sinks import days, keyed, marks
from ebbtide.sinks.records import keyed_records
from ebbtide.sources import snapshots
from tests.test_normalise import folder

RANKED = "Position bigint, Code string, Percent double"


def snapshot(spark, day, codes, add=0.0):
    rows = [(f"C{i}", f"n{i}", i, 2 * i, i / 4 + add, "x", day) for i in range(codes)]
    names = "code string, name string, shorts bigint, total bigint, percent float"
    return spark.createDataFrame(rows, names + ", industry string, date int")


def test_a_day_is_replaced_whole(spark, tmp_path, rows_of):
    path = str(tmp_path / "days")
    days.write_days(snapshot(spark, 20181001, 5).unionByName(snapshot(spark, 20181002, 5)), path)
    days.write_days(snapshot(spark, 20181002, 3, add=1), path)
    stored = spark.read.parquet(path)
    assert rows_of(stored, "date", "code", "percent") == sorted(
        [(20181001, f"C{i}", i / 4) for i in range(5)]
        + [(20181002, f"C{i}", i / 4 + 1) for i in range(3)]
    )


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).select(
            F.xxhash64("id").cast("string").alias("code"), F.lit(20181001).alias("date")
        )
        days.write_days(df, str(tmp_path / "days"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "days" / "date=20181001").glob("*.parquet"))
    assert len(files) > 3


@pytest.mark.parametrize("rows_per_document", [4, 1000])
def test_documents_come_back_whole(spark, tmp_path, rows_of, rows_per_document):
    path = str(tmp_path / "documents")
    both = snapshot(spark, 20181001, 50).unionByName(snapshot(spark, 20181002, 7))
    days.write_documents(both, path, rows_per_document)
    files = list((tmp_path / "documents" / "date=20181001").glob("*.json"))
    assert (len(files) > 5) == (rows_per_document == 4)
    small = list((tmp_path / "documents" / "date=20181002").glob("*.json"))
    assert len(small) <= 2
    for file in files:
        assert set(json.loads(file.read_text())) == {"result"}
    read = snapshots.read_documents(spark, path, file_pattern=r"date=(\d{8})/")
    columns = ["date", *SNAPSHOT_ROW.fieldNames()]
    assert rows_of(read, *columns) == rows_of(both, *columns)


def test_keyed_tables(spark, tmp_path, rows_of):
    root = str(tmp_path / "ranked")
    assert keyed.read_table(spark, root) is None
    keyed.upsert(spark.createDataFrame([(0, "A", 1.0), (1, "B", 0.5)], RANKED), root, ["Position"])
    before = keyed.read_table(spark, root)
    keyed.upsert(spark.createDataFrame([(0, "C", 2.0), (7, "D", 0.1)], RANKED), root, ["Position"])
    assert rows_of(keyed.read_table(spark, root)) == [(0, "C", 2.0), (1, "B", 0.5), (7, "D", 0.1)]
    assert rows_of(before) == [(0, "A", 1.0), (1, "B", 0.5)]
    keyed.replace(spark.createDataFrame([(0, "E", 3.0)], RANKED), root)
    assert rows_of(keyed.read_table(spark, root)) == [(0, "E", 3.0)]
    keyed.drop_old_versions(spark, root, keep=2)
    assert sorted(p.name for p in (tmp_path / "ranked").glob("v*")) == ["v2", "v3"]
    assert rows_of(keyed.read_table(spark, root)) == [(0, "E", 3.0)]


def test_an_unfinished_version_does_not_count(spark, tmp_path, rows_of):
    root = tmp_path / "ranked"
    keyed.replace(spark.createDataFrame([(0, "A", 1.0)], RANKED), str(root))
    (root / "v2").mkdir()
    (root / "v2" / "part-0.parquet").write_bytes(b"half")
    assert rows_of(keyed.read_table(spark, str(root))) == [(0, "A", 1.0)]
    keyed.replace(spark.createDataFrame([(0, "B", 1.0)], RANKED), str(root))
    assert rows_of(keyed.read_table(spark, str(root))) == [(0, "B", 1.0)]


def test_marks(spark, tmp_path):
    root = str(tmp_path / "marks")
    assert marks.read_mark(spark, root, "latestDate") is None
    with pytest.raises(ValueError):
        marks.write_mark(spark, root, "latestDate", "")
    marks.write_mark(spark, root, "source", "2020-11-05T04:09:30+00:00")
    for value, expected in ((20200229, "20200229"), (20191231, "20200229"), (20200302, "20200302")):
        marks.advance_mark(spark, root, "latestDate", value)
        assert marks.read_mark(spark, root, "latestDate") == expected
    marks.advance_mark(spark, root, "latestDate", None)
    assert marks.read_mark(spark, root, "latestDate") == "20200302"
    assert marks.read_mark(spark, root, "source") == "2020-11-05T04:09:30+00:00"


def test_records(spark):
    df = spark.createDataFrame([("k1", 1, 0.5), ("k2", 2, None)], "code string, n int, p double")
    rows = keyed_records(df, "code").collect()
    assert [r["key"] for r in rows] == ["k1", "k2"]
    assert json.loads(rows[0]["value"]) == {"code": "k1", "n": 1, "p": 0.5}


def test_the_jobs_from_files_to_tables(spark, tmp_path, rows_of):
    listing, landing = folder(tmp_path)
    table, mark = str(tmp_path / "days"), str(tmp_path / "marks")
    with pytest.raises(ValueError):
        jobs.marked_day(spark, mark)
    jobs.backfill(spark, listing, landing, table, mark)
    assert jobs.marked_day(spark, mark) == dt.date(2018, 10, 5)
    stored = spark.read.parquet(table)
    assert stored.count() == 8

    series, ranked = str(tmp_path / "series"), str(tmp_path / "ranked")
    jobs.ingest_series(stored, series)
    assert rows_of(
        spark.read.parquet(series).where("Shorts > 0"), "Code", "Date", "Name", "Percent"
    ) == [("AAA", 20181001, "one", 0.5), ("BBB", 20181005, "newer two", 2.5)]
    jobs.ingest_ranked(stored.where("date = 20181005"), ranked)
    assert rows_of(keyed.read_table(spark, ranked)) == [(0, "BBB", 2.5), (1, "AAA", 0.0)]
    jobs.ingest_ranked(stored.where("date = 20181005 and code = 'AAA'"), ranked, merge=True)
    assert rows_of(keyed.read_table(spark, ranked)) == [(0, "AAA", 0.0), (1, "AAA", 0.0)]
    jobs.ingest_ranked(stored.where("date = 20181005 and code = 'AAA'"), ranked)
    assert rows_of(keyed.read_table(spark, ranked)) == [(0, "AAA", 0.0)]

    ordered, coded = str(tmp_path / "ordered"), str(tmp_path / "coded")
    jobs.ingest_movers(stored, jobs.marked_day(spark, mark), ordered, coded)
    assert keyed.read_table(spark, ordered).columns == movers.ORDERED_COLUMNS
    assert rows_of(keyed.read_table(spark, coded), "Code", "DayChange") == [
        ("AAA", -99999999.0),
        ("BBB", -99999999.0),
    ]


def test_intermediate_results_go_to_the_named_folder(spark):
    folder_name = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder_name
    assert scratch_path(spark, "x").startswith(folder_name)
    stored = materialise(spark.range(10))
    assert stored.count() == 10 and "Range" not in stored._jdf.queryExecution().toString()
