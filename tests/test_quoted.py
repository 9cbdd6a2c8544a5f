"""Records with line breaks within quotes, and files judged as a whole."""

import csv
import io
import random

import pytest

from ebbtide.plans.normalise import normalise_folder
from ebbtide.sources import lines, quoted, reports
from tests.test_sources import put, report


@pytest.fixture
def small_splits(spark):
    """Splits of a few lines, so that records go over several of them."""
    sizes = {"spark.sql.files.maxPartitionBytes": "48b", "spark.sql.files.openCostInBytes": "1b"}
    before = {name: spark.conf.get(name) for name in sizes}
    for name, value in sizes.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def made_file(seed, separator, end):
    maker = random.Random(seed)
    parts = ["a", "bb", '"', "\n", "\n\n", separator, " x ", "é日", "1.5", ""]
    rows = []
    for _ in range(40):
        plain = maker.random() < 0.5
        pool = [p for p in parts if plain is False or p not in ('"', "\n", "\n\n", separator)]
        row = ["".join(maker.choices(pool, k=maker.randint(0, 5))) for _ in range(maker.randint(1, 4))]
        rows.append(row if row != [""] else ["z"])
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=separator, lineterminator="\n").writerows(rows)
    return rows, out.getvalue().replace("\n", end)


@pytest.mark.parametrize(("separator", "end"), [(",", "\n"), ("\t", "\r\n"), (" ", "\n"), ("|", "\n")])
def test_records_equal_the_csv_module(spark, tmp_path, small_splits, separator, end):
    expected = {}
    for n in range(4):
        rows, text = made_file(17 * n + len(end), separator, end)
        if n == 3:
            rows, text = [["only", "plain"], ["lines"]], f"only{separator}plain{end}{end}lines"
        path = put(tmp_path / f"f{n}.txt", text)
        read = csv.reader(io.StringIO(text.replace("\r\n", "\n"), newline=""), delimiter=separator)
        assert [r for r in read if r] == rows
        expected[path] = rows
    landed = lines.read_lines(spark, str(tmp_path))
    assert landed.select("file", "block").distinct().count() > 20
    found = lines.delimited_rows(landed, separator).orderBy("file", *lines.LINE_ORDER).collect()
    for path, rows in expected.items():
        assert [r.fields for r in found if r.file.endswith(path.rsplit("/", 1)[1])] == rows


def test_broken_quoting_costs_few_lines(spark, tmp_path, small_splits):
    content = (
        'a,"b\nc",d\n'          # a break within quotes
        'bad"quote,x\n'         # a quote within an unquoted field opens nothing
        'e,"f"g,h\n'            # text after a closing quote
        'i,"stray,j\n'          # no quote closes this before the next quoted field
        "k,l,m\n"
        'n,"o",p\n'
        'q,"r\n\n""s""",t\n'
        'u,"never closed\n'
        "v,w,x\n"
    )
    put(tmp_path / "harmed.csv", content)
    landed = lines.read_lines(spark, str(tmp_path))
    rows = lines.delimited_rows(landed).orderBy(*lines.LINE_ORDER).collect()
    assert [r.fields for r in rows] == [
        ["a", "b\nc", "d"], ["k", "l", "m"], ["n", "o", "p"], ["q", 'r\n\n"s"', "t"], ["v", "w", "x"]
    ]
    rejected = [r.line for r in reports.rejected_listing(landed).collect()]
    assert sorted(rejected) == sorted(['bad"quote,x', 'e,"f"g,h', 'i,"stray,j', 'u,"never closed'])
    single = lines.delimited_rows(landed, breaks=False).collect()
    assert ["a", "b\nc", "d"] not in [r.fields for r in single]


def test_a_record_too_long_to_be_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_RECORD_BYTES", 50)
    put(tmp_path / "long.csv", 'a,"' + "line,x\n" * 20 + '",b\nc,"d\ne",f\n')
    rows = lines.delimited_rows(lines.read_lines(spark, str(tmp_path))).collect()
    assert ["c", "d\ne", "f"] in [r.fields for r in rows]
    assert [r.fields for r in rows].count(["line", "x"]) == 19


def test_states_of_lines(spark):
    text = ['"', 'a,"b', '"a",b', 'a"b', '""', 'a,"b""', '"a"x,"b', '"",""', 'x","y', "plain", '","']
    frame = spark.createDataFrame([(t,) for t in text], "line string")
    got = {
        r.line: (r.o, r.i)
        for r in frame.select(
            "line",
            quoted.ends_inside(frame.line, ",", False).alias("o"),
            quoted.ends_inside(frame.line, ",", True).alias("i"),
        ).collect()
    }
    assert got == {
        '"': (True, False), 'a,"b': (True, False), '"a",b': (False, False), 'a"b': (False, False),
        '""': (False, True), 'a,"b""': (True, False), '"a"x,"b': (False, False),
        '"",""': (False, True), 'x","y': (True, True), "plain": (False, True), '","': (False, True),
    }


def test_files_judged_as_a_whole(spark, tmp_path, rows_of):
    listing = put(tmp_path / "codes.csv", 'Alpha,AAA,X\n"Beta\nLtd",BBB,Y\n')
    good = "Alpha\tAAA\t1\t2\t0.5\n" + '"Beta\nLtd"\tBBB\t3\t4\t1.5\n'
    report(tmp_path / "r", "20190614", good)
    report(tmp_path / "r", "20190617", good + 'Gam"ma\tCCC\t5\t6\t2.5\n')
    lenient = normalise_folder(spark, listing, str(tmp_path / "r"))
    strict = normalise_folder(spark, listing, str(tmp_path / "r"), strict=True)
    columns = ("date", "code", "name", "shorts")
    assert rows_of(lenient, *columns) == [
        (20190614, "AAA", "Alpha", 1), (20190614, "BBB", "Beta\nLtd", 0),
        (20190617, "AAA", "Alpha", 1), (20190617, "BBB", "Beta\nLtd", 0),
    ]
    assert rows_of(strict, *columns) == [
        (20190614, "AAA", "Alpha", 1), (20190614, "BBB", "Beta\nLtd", 3),
        (20190617, "AAA", "Alpha", 0), (20190617, "BBB", "Beta\nLtd", 0),
    ]
    put(tmp_path / "codes.csv", 'Alpha,AAA,X\nBe"ta,BBB,Y\n')
    with pytest.raises(ValueError, match="broken quoting"):
        normalise_folder(spark, listing, str(tmp_path / "r"), strict=True)
