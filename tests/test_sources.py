import datetime as dt
import gzip
import json
import os
import random

import pytest

from ebbtide.plans import normalise
from ebbtide.schemas import LISTING, POSITION, SNAPSHOT_ROW
from ebbtide.sinks import days
from ebbtide.sources import lines, reports, snapshots


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def report(root, day, content):
    return put(root / day[:4] / day[4:6] / f"RR{day}-001-SSDailyAggShortPos.csv", content)


def made_reports(seed, count):
    """Report lines, some of them broken, and the records in the others."""
    maker = random.Random(seed)
    text, kept = [], []
    for n in range(count):
        fields = [
            f"Firm {n}",
            f"F{n:03}" + " " * maker.randint(0, 3),
            str(maker.randint(0, 10**9)),
            str(maker.randint(0, 10**12)),
            f"{maker.random() * 40:.6f}",
        ]
        harm = maker.choice(["none", "none", "word", "short", "long", "space"])
        if harm == "word":
            fields[maker.randint(2, 4)] = maker.choice(["many", "", "1d", "--"])
        elif harm == "short":
            fields.pop(maker.randint(0, 4))
        elif harm == "long":
            fields.insert(maker.randint(0, 5), "9")
        elif harm == "space":
            place = maker.randint(2, 4)
            fields[place] = " " + fields[place]
        else:
            kept.append((fields[0], fields[1].rstrip(), int(fields[2]), int(fields[3]), fields[4]))
        text.append("\t".join(fields))
    return text, sorted(kept)


def test_report_rows(spark, tmp_path, rows_of):
    text, kept = made_reports(31, 80)
    report(tmp_path, "20190614", "a\tb\tc\td\te\n\n" + "\n".join(text))
    landed = lines.read_lines(spark, str(tmp_path))
    found = rows_of(reports.positions(landed), "name", "code", "shorts", "total", "date")
    assert found == [(*row[:4], 20190614) for row in kept]
    percents = {r["code"]: r["percent"] for r in reports.positions(landed).collect()}
    assert percents == {row[1]: pytest.approx(float(row[4]), rel=1e-6) for row in kept}
    rejected = rows_of(reports.rejected_positions(landed), "line")
    assert len(rejected) == 81 - len(kept)


def test_pruned_reads_keep_the_same_rows(spark, tmp_path):
    report(tmp_path, "20180925", "h\th\th\th\th\nA\tAAA\t1\t2\t3\nB\tBBB\t1\t2\n")
    rows = reports.read_positions(spark, str(tmp_path))
    assert rows.count() == 1
    assert [r["code"] for r in rows.select("code").collect()] == ["AAA"]


def test_two_byte_text(spark, tmp_path, rows_of):
    text = "Product\tCode\tShorts\tTotal\t%\r\nONE\tAAA \t1\t2\t3.5\r\nTWO\tBBB\t4\t5\t6.5\r\n"
    report(tmp_path, "20180925", text.encode("utf-16"))
    rows = reports.read_positions(spark, str(tmp_path))
    assert rows_of(rows, "name", "code", "shorts", "percent") == [
        ("ONE", "AAA", 1, 3.5),
        ("TWO", "BBB", 4, 6.5),
    ]


def test_listing_rows(spark, tmp_path, rows_of):
    path = put(
        tmp_path / "codes.csv",
        'one,AAA,Energy\ntwo,BBB\n"three, ltd",CCC,"Food ""and"" Drink"\na"b,DDD,X\na,b,c,d\n',
    )
    landed = lines.read_lines(spark, path)
    assert rows_of(reports.listing(landed), "name", "code", "industry") == [
        ("one", "AAA", "Energy"),
        ("three, ltd", "CCC", 'Food "and" Drink'),
    ]
    assert len(rows_of(reports.rejected_listing(landed), "line")) == 3


def test_preamble(spark, tmp_path):
    maker = random.Random(12)
    body = "".join(f"firm {n},{maker.randint(0, 99)},sector {n % 4}\n" for n in range(25)) + "\n"
    put(tmp_path / "in" / "codes.csv", f"as of today\n\nfirm,code,sector\n{body}")
    cleaned = normalise.clean_listing(spark, str(tmp_path / "in"))
    normalise.land_lines(cleaned, str(tmp_path / "out"))
    landed = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert landed == body.encode()


@pytest.mark.parametrize("split_bytes", ["64", "1024", "128m"])
def test_preamble_and_unended_line_per_file_and_split(spark, tmp_path, split_bytes, rows_of):
    for n in range(3):
        body = "".join(f"name {n} {i},C{n}{i:03},X\n" for i in range(60))
        put(tmp_path / f"codes{n}.csv", f"title {n}\n\nname,code,industry\n{body}cut,off,line")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        cleaned = lines.skip_preamble(lines.read_lines(spark, str(tmp_path)))
        assert cleaned.select("block").distinct().count() > 1 or split_bytes == "128m"
        found = rows_of(reports.listing(cleaned), "code")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == sorted((f"C{n}{i:03}",) for n in range(3) for i in range(60))


@pytest.mark.parametrize("split_bytes", ["100", "128m"])
def test_the_last_line_of_a_code_wins(spark, tmp_path, split_bytes, rows_of):
    rng = random.Random(11)
    expected, content = {}, []
    for i in range(500):
        code = f"C{rng.randrange(12)}" if rng.random() < 0.6 else "HOT"
        content.append(f"n{i}\t{code}\t{i}\t{i}\t{i}\n")
        expected[code] = i
    report(tmp_path, "20180925", "".join(content))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = normalise.latest_positions(reports.read_positions(spark, str(tmp_path)))
        assert rows_of(rows, "code", "shorts") == sorted(expected.items())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_newer_file_of_a_day_wins(spark, tmp_path, rows_of):
    first = put(tmp_path / "b" / "RR20180925-001-SSDailyAggShortPos.csv", "A\tAAA\t1\t1\t1\n")
    second = put(tmp_path / "a" / "RR20180925-001-SSDailyAggShortPos.csv", "A\tAAA\t2\t2\t2\n")
    os.utime(first, (1_600_000_000, 1_600_000_000))
    os.utime(second, (1_600_000_100, 1_600_000_100))
    rows = normalise.latest_positions(reports.read_positions(spark, str(tmp_path)))
    assert rows_of(rows, "code", "shorts") == [("AAA", 2)]


def test_delimited_rows_of_any_length(spark, tmp_path):
    path = put(tmp_path / "any.txt", 'a,b\r\n\nc\n"d,e",f,g\nbad"quote,x\n')
    rows = lines.delimited_rows(lines.read_lines(spark, path)).orderBy("seq").collect()
    assert [r["fields"] for r in rows] == [["a", "b"], ["c"], ["d,e", "f", "g"]]


def test_changed_files_only(spark, tmp_path, rows_of):
    old = put(tmp_path / "old.txt", "old\n")
    new = put(tmp_path / "new.txt", "new\n")
    moment = dt.datetime(2019, 2, 3, 17, 20, 5, tzinfo=dt.UTC).timestamp()
    os.utime(old, (moment, moment))
    os.utime(new, (moment + 86400, moment + 86400))

    def read(mark):
        return rows_of(lines.changed_lines(spark, str(tmp_path), mark), "line")

    assert read("2019-02-03T17:20:05+00:00") == [("new",)]
    assert read("2019-02-03T17:20:04+00:00") == [("new",), ("old",)]
    assert read("2019-02-04T03:20:05+10:00") == [("new",)]
    assert read("2019-02-04T17:20:05Z") == []
    for mark in (None, "", "noon", "2019-02-03T17:20:05"):
        with pytest.raises(ValueError):
            read(mark)
    everything = lines.read_lines(spark, str(tmp_path))
    newest = lines.newest_change(everything).first()["mark"]
    assert dt.datetime.fromisoformat(newest).timestamp() == moment + 86400


def test_json_arrays(spark, tmp_path, rows_of):
    maker = random.Random(44)
    makers = {
        "name": lambda: f"firm {maker.randint(0, 50)}",
        "code": lambda: f"K{maker.randint(0, 99):02}",
        "industry": lambda: maker.choice(["Mining", "Rail"]),
        "shorts": lambda: maker.randint(0, 10**10),
        "total": lambda: maker.randint(0, 10**10),
        "percent": lambda: maker.randint(0, 400) / 8,
    }
    for number, schema in enumerate((LISTING, POSITION, SNAPSHOT_ROW)):
        rows = [
            {f: makers[f]() for f in schema.fieldNames() if f in makers and maker.random() < 0.7}
            for _ in range(20)
        ]
        text = "[" + ",\n".join(json.dumps(row) for row in rows) + "]"
        path = put(tmp_path / f"{number}.json", text)
        empty = {f.name: "" if f.dataType.simpleString() == "string" else 0 for f in schema}
        wanted = sorted(tuple({**empty, **row}.values()) for row in rows)
        assert rows_of(snapshots.read_json_rows(spark, path, schema)) == wanted


def test_documents(spark, tmp_path, rows_of):
    row = {"code": "A", "name": "a", "shorts": 1, "total": 2, "percent": 0.5, "industry": "i"}
    put(tmp_path / "20180901.json", json.dumps({"result": [row, {"code": "B"}]}))
    put(tmp_path / "20180902.json", json.dumps({"result": []}))
    put(tmp_path / "20180903.json", json.dumps({"result": [row]}))
    read = snapshots.read_documents(spark, str(tmp_path))
    assert rows_of(read, "date", "code", "shorts", "percent") == [
        (20180901, "A", 1, 0.5),
        (20180901, "B", 0, 0.0),
        (20180903, "A", 1, 0.5),
    ]


def test_a_broken_document_fails_the_job(spark, tmp_path):
    put(tmp_path / "20180901.json", '{"result": [{"code": "A", ')
    with pytest.raises(Exception, match="(?i)malformed"):
        snapshots.read_documents(spark, str(tmp_path)).collect()


def test_report_path():
    path = reports.report_path("/landing/", "20180925")
    assert path == "/landing/2018/09/RR20180925-001-SSDailyAggShortPos.csv"


def test_files_changed_in_the_second_of_the_mark(spark, tmp_path, rows_of):
    for name, moment in (("a", 1_600_000_000.2), ("b", 1_600_000_000.8)):
        os.utime(put(tmp_path / f"{name}.txt", f"{name}\n"), (moment, moment))
    mark = lines.newest_change(lines.read_lines(spark, str(tmp_path / "a.txt"))).first()["mark"]
    assert rows_of(lines.changed_lines(spark, str(tmp_path), mark), "line") == [("b",)]


def test_the_last_line_of_a_compressed_listing_stays(spark, tmp_path):
    text = "t\n\nh\n" + "".join(f"name {i},C{i:02},X\n" for i in range(50))
    (tmp_path / "codes.csv.gz").write_bytes(gzip.compress(text.encode()))
    cleaned = lines.skip_preamble(lines.read_lines(spark, str(tmp_path)))
    assert cleaned.count() == 50


def test_documents_are_read_back_by_default(spark, tmp_path, rows_of):
    row = ("C", "n", 1, 2, 0.5, "i", 20190304)
    fields = "code string, name string, shorts long, total long, percent float, industry string, date int"
    days.write_documents(spark.createDataFrame([row], fields), str(tmp_path / "d"))
    found = snapshots.read_documents(spark, str(tmp_path / "d"))
    assert rows_of(found, "date", "code", "shorts") == [(20190304, "C", 1)]


def test_half_open_ranges(spark, tmp_path):
    listing = put(tmp_path / "codes.csv", "one,AAA,Energy\n")
    for day in ("20190301", "20190302", "20190303"):
        report(tmp_path / "r", day, "x\tAAA\t1\t1\t1\n")
    read = lambda *ends: {
        r["date"]
        for r in normalise.normalise_folder(spark, listing, str(tmp_path / "r"), *ends).collect()
    }
    assert read(dt.date(2019, 3, 2)) == {20190302, 20190303}
    assert read(None, dt.date(2019, 3, 2)) == {20190301}
    assert read(dt.date(2019, 3, 2), dt.date(2019, 3, 3)) == {20190302}
    assert read(dt.date(2020, 1, 1)) == set()


def test_files_outside_the_range_are_not_opened(spark, tmp_path):
    listing = put(tmp_path / "codes.csv", "one,AAA,Energy\n")
    report(tmp_path / "r", "20190301", "x\tAAA\t1\t1\t1\n")
    report(tmp_path / "r", "20190302", "x\tAAA\t1\t1\t1\n")
    found = normalise.normalise_folder(
        spark, listing, str(tmp_path / "r"), dt.date(2019, 3, 2), dt.date(2019, 3, 3)
    )
    assert all("20190301" not in name for name in found.inputFiles())
