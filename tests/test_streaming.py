import json
import os

import pytest

from ebbtide.plans.normalise import latest_listing
from ebbtide.sinks import marks
from ebbtide.sources import lines, reports
from ebbtide.streaming.ingest import ingest_reports, publish_records
from tests.test_normalise import folder
from tests.test_sources import report


def test_new_files_are_taken_once(spark, tmp_path, rows_of):
    listing, landing = folder(tmp_path)
    table, mark = str(tmp_path / "days"), str(tmp_path / "marks")
    batches = []

    def codes():
        return latest_listing(reports.listing(lines.read_lines(spark, listing)))

    def run(days_per_batch=31):
        ingest_reports(
            spark,
            landing,
            codes,
            table,
            mark,
            str(tmp_path / "ledger"),
            days_per_batch=days_per_batch,
            then=lambda rows: batches.append({r["date"] for r in rows.collect()}),
        )

    def stored():
        return rows_of(spark.read.parquet(table), "date", "code", "shorts")

    run(days_per_batch=3)
    assert sorted(map(len, batches)) == [1, 3], batches
    first = stored()
    assert first == [
        (20181001, "AAA", 1),
        (20181001, "BBB", 0),
        (20181002, "AAA", 0),
        (20181002, "BBB", 0),
        (20181003, "AAA", 0),
        (20181003, "BBB", 0),
        (20181005, "AAA", 0),
        (20181005, "BBB", 6),
    ]
    assert marks.read_mark(spark, mark, marks.LATEST_DAY) == "20181005"

    batches.clear()
    run()
    assert batches == [] and stored() == first

    report(tmp_path / "landing", "20180930", "x\tAAA\t4\t4\t4\n")
    run()
    assert batches == [{20180930}]
    assert stored() == [(20180930, "AAA", 4), (20180930, "BBB", 0), *first]
    assert marks.read_mark(spark, mark, marks.LATEST_DAY) == "20181005"

    report(tmp_path / "landing", "20181008", "")
    run()
    assert batches == [{20180930}, {20181008}]
    assert stored()[-2:] == [(20181008, "AAA", 0), (20181008, "BBB", 0)]
    assert marks.read_mark(spark, mark, marks.LATEST_DAY) == "20181008"


def test_a_batch_that_is_run_again_ends_in_the_same_tables(spark, tmp_path, rows_of):
    listing, landing = folder(tmp_path)
    report(tmp_path / "landing", "20181008", "")
    table, mark = str(tmp_path / "days"), str(tmp_path / "marks")
    calls = []

    def codes():
        return latest_listing(reports.listing(lines.read_lines(spark, listing)))

    def fail_once(rows):
        calls.append(rows.count())
        if len(calls) == 1:
            raise RuntimeError("lost")

    def run():
        ingest_reports(
            spark, landing, codes, table, mark, str(tmp_path / "ledger"), then=fail_once
        )

    with pytest.raises(Exception, match="lost"):
        run()
    before = rows_of(spark.read.parquet(table), "date", "code", "shorts")
    run()
    assert rows_of(spark.read.parquet(table), "date", "code", "shorts") == before
    assert len(before) == 10
    assert marks.read_mark(spark, mark, marks.LATEST_DAY) == "20181008"


def test_a_day_in_several_files_is_whole_whenever_they_arrive(spark, tmp_path, rows_of):
    listing, _ = folder(tmp_path)
    landing = tmp_path / "parts"

    def codes():
        return latest_listing(reports.listing(lines.read_lines(spark, listing)))

    def run():
        ingest_reports(
            spark, str(landing), codes, str(tmp_path / "t"), str(tmp_path / "m"),
            str(tmp_path / "p"), days_per_batch=1,
        )
        return rows_of(spark.read.parquet(str(tmp_path / "t")), "date", "code", "shorts")

    report(landing / "a", "20181001", "x\tAAA\t1\t1\t1\n")
    assert run() == [(20181001, "AAA", 1), (20181001, "BBB", 0)]
    report(landing / "b", "20181001", "x\tBBB\t2\t2\t2\n")
    assert run() == [(20181001, "AAA", 1), (20181001, "BBB", 2)]


def test_late_corrected_and_emptied_reports_are_taken(spark, tmp_path, rows_of):
    listing, _ = folder(tmp_path)
    landing, table = tmp_path / "lots", str(tmp_path / "t")

    def run():
        ingest_reports(
            spark,
            str(landing),
            lambda: latest_listing(reports.listing(lines.read_lines(spark, listing))),
            table,
            str(tmp_path / "m"),
            str(tmp_path / "l"),
        )
        return rows_of(spark.read.parquet(table).where("code = 'AAA'"), "date", "shorts")

    report(landing, "20181001", "x\tAAA\t1\t1\t1\n")
    assert run() == [(20181001, 1)]
    late = report(landing, "20180903", "x\tAAA\t7\t1\t1\n")
    os.utime(late, (1_500_000_000, 1_500_000_000))
    assert run() == [(20180903, 7), (20181001, 1)]
    report(landing, "20181001", "x\tAAA\t95\t1\t1\n")
    assert run() == [(20180903, 7), (20181001, 95)]
    report(landing, "20180903", "")
    assert run() == [(20180903, 0), (20181001, 95)]


def test_published_records(spark, tmp_path):
    source, out = str(tmp_path / "in"), tmp_path / "out"
    spark.createDataFrame([("A", 1), ("B", 2)], "code string, n int").write.parquet(source)
    stream = spark.readStream.schema("code string, n int").parquet(source)
    publish_records(stream, "code", str(out), str(tmp_path / "progress")).awaitTermination()
    rows = [json.loads(line) for f in out.glob("part-*") for line in f.read_text().splitlines()]
    found = sorted((r["key"], json.loads(r["value"])["n"]) for r in rows)
    assert found == [("A", 1), ("B", 2)]
