from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from catalogue import daily, dates, files, stored
from verify import rows_of as ordered_rows

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for file in sorted(TABLES.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_of_the_catalogue_has_its_sql():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(daily.QUERIES | dates.QUERIES | stored.QUERIES | files.QUERIES) <= set(
        contract.oracle_sql()
    )


def test_entry(spark):
    assert contract.entry(spark).count() == 100


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    result = contract.queries()[name](spark, str(TABLES))
    got = ordered_rows(result.columns, [tuple(r) for r in result.collect()])
    answer = connection.execute(contract.oracle_sql()[name])
    want = ordered_rows([d[0] for d in answer.description], answer.fetchall())
    assert got == want
    assert got[1], "no rows"


def test_top_series_reads_its_window_only(spark, plan_of):
    plan = plan_of(contract.queries()["top_series"](spark, str(TABLES)))
    parts = [part for part in plan.split("\n\n") if "events.parquet" in part]
    assert 1 <= len(parts) <= 2
    for part in parts:
        pushed = part.split("PushedFilters:")[1]
        assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_reports_land_under_their_own_names(spark, tmp_path):
    files.land_reports(files.report_lines(spark, str(TABLES)), str(tmp_path / "landing"))
    names = [path.name for path in (tmp_path / "landing").rglob("*.csv")]
    days = spark.read.parquet(str(TABLES / "events.parquet")).selectExpr("date(ts)").distinct()
    assert sorted(names) == sorted(
        f"RR{row[0]:%Y%m%d}-001-SSDailyAggShortPos.csv" for row in days.collect()
    )
