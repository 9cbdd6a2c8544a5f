import datetime as dt
import json
import os

import pytest

from ebbtide.plans import queries
from ebbtide.plans.desk import Desk
from ebbtide.sinks import marks
from tests.test_sources import put, report

TODAY = dt.date(2018, 10, 9)


@pytest.fixture
def desk(spark, tmp_path):
    download = put(
        tmp_path / "download" / "codes.csv",
        'Listed codes\n\nname,code,industry\n"One, Ltd",AAA,Energy\ntwo,BBB,Food\nthree,CCC,Food\n',
    )
    made = Desk(spark, str(tmp_path))
    made.fetch_listing(download)
    return made


def test_the_pipeline_from_download_to_answers(desk, tmp_path, rows_of):
    for day, aaa, bbb in (
        ("20171009", 5.0, 1.0),
        ("20180907", 4.0, 1.0),
        ("20181002", 3.0, 1.0),
        ("20181008", 2.5, 1.0),
        ("20181009", 2.0, 4.0),
    ):
        report(tmp_path / "reports", day, f"x\tAAA\t1\t2\t{aaa}\nx\tBBB\t3\t4\t{bbb}\n")
    desk.backfill(dt.date(2018, 10, 15), 12)
    assert desk.days().count() == 15
    desk.ingest_day(20181008)
    desk.ingest_day(20181009)
    desk.ingest_movers()

    assert [tuple(r) for r in desk.top_shorts("2").collect()] == [(0, "BBB", 4.0), (1, "AAA", 2.0)]
    assert rows_of(desk.movers_of("AAA")) == [("AAA", -0.5, -1.0, -2.0, -3.0)]
    assert desk.movers_of("ZZZ").collect() == []
    movers = desk.top_movers("4").collect()
    assert [(r["order"], r["dayCode"], r["yearChange"]) for r in movers] == [
        (1, "CCC", 0.0),
        (2, "AAA", -3.0),
        (3, "BBB", 3.0),
    ]
    answer = queries.series_json(desk.top_series(TODAY, "1", "MONTH")).first()[0]
    assert json.loads(answer) == {
        "BBB": [{"Date": 20181008, "Percent": 1.0}, {"Date": 20181009, "Percent": 4.0}]
    }
    for number in ("0", "101", "x"):
        with pytest.raises(ValueError):
            desk.top_shorts(number)


def test_a_report_is_normalised_only_when_changed(desk, spark, tmp_path, rows_of):
    with pytest.raises(ValueError):
        desk.normalise("20181003", "reports")
    moment = int(dt.datetime(2018, 8, 11, 9, 46, 37, tzinfo=dt.UTC).timestamp())
    marks.write_mark(spark, desk.path("marks"), "reports", "2018-08-11T09:46:37+00:00")
    assert desk.normalise("20181003", "reports") is False
    path = report(tmp_path / "reports", "20181003", "x\tAAA\t1\t2\t3\n")
    os.utime(path, (moment, moment))
    assert desk.normalise("20181003", "reports") is False
    os.utime(path, (moment + 60, moment + 60))
    assert desk.normalise("20181003", "reports") is True
    assert rows_of(desk.days(), "date", "code", "name", "shorts") == [
        (20181003, "AAA", "One, Ltd", 1),
        (20181003, "BBB", "two", 0),
        (20181003, "CCC", "three", 0),
    ]
    assert marks.read_mark(spark, desk.path("marks"), "reports") == "2018-08-11T09:47:37+00:00"
    assert desk.normalise("20181003", "reports") is False


def test_lags_behind_the_calendar(desk):
    assert desk.report_day(TODAY) == "20181003"
    assert desk.ingest_day_number(TODAY) == 20181005


def test_tables_not_written_yet(desk):
    with pytest.raises(ValueError):
        desk.top_movers()
