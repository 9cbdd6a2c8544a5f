"""Series as JSON documents with a manifest."""

from pathlib import Path

from pyspark.sql import functions as F

from ebbtide.sinks import series


def made(spark, count):
    points = F.transform(
        F.sequence(F.lit(1), F.pmod("id", F.lit(4)).cast("int") + 1),
        lambda d: F.struct((d + 20190600).alias("Date"), (d / 4).alias("Percent")),
    )
    code = F.format_string("C%06d", "id").alias("Code")
    return spark.range(count).select(code, points.alias("series")).repartition(5)


def test_documents_hold_few_codes_and_give_all_back(spark, tmp_path, plan_of):
    path = str(tmp_path / "s")
    rows = made(spark, 1003)
    series.write_series(rows, path, codes_per_document=100)
    manifest = series.read_manifest(spark, path).orderBy("part").collect()
    assert [m.codes for m in manifest] == [100] * 10 + [3]
    assert manifest[0].first == "C000000" and manifest[-1].last == "C001002"
    assert all(a.last < b.first for a, b in zip(manifest, manifest[1:], strict=False))
    key = lambda r: (r.Code, [tuple(p) for p in r.series])
    assert sorted(map(key, series.read_series(spark, path).collect())) == sorted(
        map(key, rows.collect())
    )
    few = series.read_series(spark, path, ["C000001", "C000777", "none"])
    assert sorted(r.Code for r in few.collect()) == ["C000001", "C000777"]
    opened = few.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(opened) == 2
    series.write_series(rows.where("Code < 'C000005'"), path, codes_per_document=3)
    assert series.read_series(spark, path).count() == 5


def test_no_codes(spark, tmp_path):
    path = str(tmp_path / "s")
    series.write_series(made(spark, 0), path)
    assert series.read_manifest(spark, path).collect() == []


def test_a_hundred_thousand_codes_make_no_large_row(spark, tmp_path):
    path = str(tmp_path / "s")
    series.write_series(made(spark, 100_000), path)
    sizes = [p.stat().st_size for p in Path(path, "documents").rglob("*.json")]
    assert len(sizes) == 50 and max(sizes) < 2 << 20
