import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import numbers, text


def parsed(spark, function, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    rows = df.select("n", function(F.col("t")).alias("v")).orderBy("n").collect()
    return [row["v"] for row in rows]


def test_whole_numbers(spark):
    texts = ["10", "-3", "+7"]
    texts += [" 10 ", "1.0", "", "1_0", "abc", "9223372036854775808", "12\r", None]
    assert parsed(spark, numbers.parse_long, texts) == [10, -3, 7] + [None] * 8


def test_reals(spark):
    texts = ["10.5", "1.", ".5", "1e3", "-2E-1", "1d", "1f", " 1", "", "asd.1", "NaN", "1e400", None]
    assert parsed(spark, numbers.parse_double, texts) == [10.5, 1.0, 0.5, 1000.0, -0.2] + [None] * 8


def test_float_range(spark):
    assert parsed(spark, numbers.parse_float, ["1e39", "1e38"])[0] is None
    assert parsed(spark, numbers.parse_float, ["73.40625"]) == [pytest.approx(73.40625, rel=1e-6)]


def test_stored_values(spark):
    assert numbers.STORED_DECIMALS == 6
    df = spark.createDataFrame(
        [("a", 1, 2, 0.1234567, 1.23456789, True)],
        "s string, i int, l bigint, f float, d double, b boolean",
    )
    row = df.select(
        [numbers.stored(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]
    ).first()
    assert row["s"] == "a" and row["i"] == 1 and row["l"] == 2
    assert row["f"] == pytest.approx(0.123457) and row["d"] == 1.234568
    assert row["b"] is None


def test_floats_widen_through_their_text(spark):
    df = spark.createDataFrame([(0.1,)], "f float")
    assert df.select(numbers.widened(F.col("f"), T.FloatType())).first()[0] == 0.1


@pytest.mark.parametrize(
    ("line", "fields"),
    [
        ("a,b,c", ["a", "b", "c"]),
        ("1, 2, 3", ["1", " 2", " 3"]),
        ("a,,", ["a", "", ""]),
        ('"x, y",b,c', ["x, y", "b", "c"]),
        ('"say ""hi""",b', ['say "hi"', "b"]),
        ('"",b', ["", "b"]),
        ('a,"b"', ["a", "b"]),
        (',"b",', ["", "b", ""]),
        ('a"b,c', None),
        ('"a"b,c', None),
        ('"open,c', None),
        ('a, "b"', None),
    ],
)
def test_fields(spark, line, fields):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(text.split_fields(F.col("line"), ",")).first()[0] == fields


def test_fields_of_other_separators(spark):
    lines = [("a\tb c\t'", 'a|b|"c|d"', "test abc")]
    df = spark.createDataFrame(lines, "t string, p string, s string")
    row = df.select(
        text.split_fields(F.col("t"), "\t"),
        text.split_fields(F.col("p"), "|"),
        text.split_fields(F.col("s"), " "),
    ).first()
    assert row[0] == ["a", "b c", "'"]
    assert row[1] == ["a", "b", "c|d"]
    assert row[2] == ["test", "abc"]


def test_a_long_quoted_field(spark):
    inner = "x" * 100_000 + '""' * 2_000
    df = spark.createDataFrame([(f'"{inner}",b',)], "line string")
    fields = df.select(text.split_fields(F.col("line"), ",")).first()[0]
    assert fields == [inner.replace('""', '"'), "b"]


def test_fields_match_a_csv_writer(spark):
    rng = random.Random(17)
    pieces = ["a", "Z", " ", ",", '"', '""', "\t", "é", "\\", "'", "|", "$1", "."]
    rows = [
        ["".join(rng.choices(pieces, k=rng.randrange(6))) for _ in range(rng.randrange(1, 7))]
        for _ in range(400)
    ]
    written = []
    for row in rows:
        line = io.StringIO()
        csv.writer(line, lineterminator="").writerow(row)
        written.append(line.getvalue())
    df = spark.createDataFrame(list(enumerate(written)), "n int, line string")
    found = df.select("n", text.split_fields(F.col("line"), ",").alias("f")).orderBy("n")
    assert [r["f"] for r in found.collect()] == rows
