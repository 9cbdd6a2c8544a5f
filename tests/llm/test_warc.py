import hashlib
import random

import pytest

from ebbtide.llm import warc

SCHEMA = "page_id long, url string, html string, next string, at long"


def pages():
    maker = random.Random(5)
    embedded = (
        f"{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\n"
        f"Content-Length: 4\r\n\r\nabcd{warc.END}"
    )
    html = [
        "",
        None,
        "x" * 1500,
        "x" * 1500,
        "é" * 600,
        "short",
        "short",
        embedded,
        embedded * 3 + "tail",
        warc.MAGIC * 4,
        warc.MAGIC + "Content-Length: 9999\r\n\r\n",
        f"{warc.END}{embedded}",
        "line\r\n\r\nline" * 900,
    ]
    html += ["".join(maker.choices(["a", "b\r\n", warc.MAGIC, warc.END], k=60)) for _ in range(40)]
    rows = [(i, None if i % 7 == 0 else f"http://h/{i}\r\nX: 1", h, "n", 3) for i, h in enumerate(html)]
    return [*rows, (None, "u", "x" * 1500, None, None)]


def expected(rows):
    holders = {}
    for key, _, html, *_ in rows:
        if key is not None:
            holders[html or ""] = max(key, holders.get(html or "", key))
    out = []
    for key, _, html, *_ in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and key != holders.get(html or "", key)
        out.append(
            (
                key,
                len(data),
                hashlib.sha1(data).hexdigest(),
                "revisit" if revisit else "response",
                holders[html] if revisit else None,
            )
        )
    return sorted(out, key=repr)


def read(spark, path):
    found = warc.read_archives(spark, path).select(
        "record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    return sorted((tuple(row) for row in found.collect()), key=repr)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    rows = pages()
    path = str(tmp_path / "archive")
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    warc.write_archives(frame, path, compression=compression)
    assert read(spark, path) == expected(rows)


def test_small_splits(spark, tmp_path):
    rows = [r for r in pages() if r[0] is not None]
    path = str(tmp_path / "archive")
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    warc.write_archives(frame, path, compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert read(spark, path) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_second_read_dealt_otherwise(spark, tmp_path, monkeypatch, compression):
    """As when executors are lost or added between the two reads of the archives."""
    rows = pages()
    path = str(tmp_path / "archive")
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    warc.write_archives(frame, path, compression=compression)
    reachable = warc.reachable
    before = spark.conf.get("spark.sql.files.openCostInBytes")

    def then_fewer(nodes):
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        return reachable(nodes)

    largest = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(warc, "reachable", then_fewer)
    monkeypatch.setattr(warc, "PIECES_PER_TEXT", 3, raising=False)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert read(spark, path) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", largest)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert read(spark, path) == []


def test_records_are_plain_warc(spark, tmp_path):
    path = tmp_path / "archive"
    frame = spark.createDataFrame([(1, "http://a/", "body", "", 0)], SCHEMA).coalesce(1)
    warc.write_archives(frame, str(path), compression="none")
    data = b"".join(p.read_bytes() for p in path.glob("part-*"))
    head, _, body = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert b"Content-Length: 4" in head.split(b"\r\n") and body == b"body\r\n\r\n"
