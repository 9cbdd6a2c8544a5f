"""Web archives: written from pages, read back by verified chains of records.

A record ends with the four bytes CR LF CR LF, so the text writer, with these as its
line end, writes archives, one record per row. The text reader, with a record's first
line as its line end, reads them in splits; every occurrence of that line is a
candidate record, those within payloads too. Each candidate tells where its successor
would begin. Only records that the chain of successors from the file's start reaches
are real; pointer jumping finds them without walking a file in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, ship, stored, with_salted

# The first line of a record and the bytes that end one.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Equal payloads of at least this many bytes are stored once.
LEAST_SHARED_BYTES = 1000
RECORDS_PER_FILE = 50_000
# A text that more pieces than this share is joined to them in several tasks.
PIECES_PER_TEXT = 1000


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """One record per row of ``pages``, into files under ``path``.

    Null html is an empty payload. Of equal payloads of ``LEAST_SHARED_BYTES`` or more
    the record with the largest id carries the payload, the others refer to it; a null
    id is below all others and is written without a number. A null url leaves its line
    out; line breaks in a url are escaped. Rows that repeat an id are written each; of
    rows that repeat the id that carries the payload, all carry it. An empty table
    makes no records. Other columns are not read.

    With ``compression`` "none" files can be read in splits; compressed files are read
    by one task each, and hold at most ``RECORDS_PER_FILE`` records.
    """
    payload = known(F.col(html))
    rows = pages.select(
        F.col(key).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumn("bytes", F.octet_length("payload"))
    rows = rows.withColumn(
        "content",
        F.when(F.col("bytes") >= LEAST_SHARED_BYTES, F.unhex(F.sha2("payload", 256))),
    )
    shared = (
        rows.where("content IS NOT NULL")
        .groupBy("content")
        .agg(F.max("id").alias("holder"), F.count("*").alias("times"))
        .where("times > 1 AND holder IS NOT NULL")
        .select("content", "holder")
    )
    rows = with_salted(rows, shared, "content")
    revisit = F.col("holder").isNotNull() & ~F.col("id").eqNullSafe(F.col("holder"))
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line(
            "WARC-Record-ID",
            F.concat(F.lit("<urn:page:"), known(F.col("id").cast("string")), F.lit(">")),
        ),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(PROFILE)),
                line("WARC-Refers-To", F.format_string("<urn:page:%d>", "holder")),
                line("Content-Length", F.lit("0")),
                F.lit("\r\n"),
            ),
        ).otherwise(
            F.concat(
                line("Content-Type", F.lit("text/html; charset=UTF-8")),
                line("Content-Length", F.col("bytes").cast("string")),
                F.lit("\r\n"),
                F.col("payload"),
            )
        ),
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).option("compression", compression).text(path)


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?m)^{name}: ?([^\r\n]*)", 1)
    return F.when(found != "", found)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """What every occurrence of a record's first line would be as a record, and where
    its successor would begin.

    Rows ``file, block, seq, bytes`` (of the text up to the next occurrence),
    ``content`` (that text's SHA-256), ``at`` (its place in the file), ``next``, the
    header's fields, and ``sha1`` of the payload if it ends just before the next
    occurrence. ``block`` and ``seq`` hold for this read alone: another may deal the
    same files out otherwise.
    """
    length = _field(F.col("header"), "Content-Length")
    parts = _lines(spark, path).withColumns(
        {
            "bytes": F.octet_length("value").cast("long"),
            "header": F.substring_index("value", END, 1),
        }
    )
    parts = parts.withColumns(
        {
            "start": F.octet_length("header") + F.lit(len(END)),
            "length": F.when(length.rlike("^[0-9]{1,15}$"), length.cast("long")),
        }
    )
    within = F.col("start") + F.col("length") + len(END) == F.col("bytes")
    payload = F.expr("substring(cast(value AS binary), start + 1, int(length))")
    parts = parts.select(
        "file",
        "block",
        "seq",
        "bytes",
        F.unhex(F.sha2("value", 256)).alias("content"),
        (len(MAGIC) + F.col("start") + F.col("length") + len(END)).alias("size"),
        "start",
        "length",
        _field(F.col("header"), "WARC-Type").alias("type"),
        _field(F.col("header"), "WARC-Record-ID").alias("record"),
        _field(F.col("header"), "WARC-Target-URI").alias("url"),
        _field(F.col("header"), "WARC-Payload-Digest").alias("digest"),
        _field(F.col("header"), "WARC-Refers-To").alias("refers"),
        _field(F.col("header"), "X-Payload-Length").alias("full"),
        F.when(within, F.sha1(payload)).alias("sha1"),
    )
    parts = stored(parts, "archive-parts")
    # Splits follow each other, and parts within a split: sums of lengths give places.
    taken = F.col("bytes") + len(MAGIC)
    earlier = Window.partitionBy("file").orderBy("block")
    blocks = parts.groupBy("file", "block").agg(F.sum(taken).alias("sum"))
    blocks = blocks.select(
        "file", "block", (F.sum("sum").over(earlier) - F.col("sum")).alias("before")
    )
    inside = Window.partitionBy("file", "block").orderBy("seq")
    end = F.col("before") + F.sum(taken).over(inside)
    placed = parts.join(blocks, ["file", "block"]).withColumn(
        "at", end - F.col("bytes") - 2 * len(MAGIC)
    )
    # The text before the first occurrence in a file is no candidate.
    return placed.where("at >= 0").withColumn("next", F.col("at") + F.col("size"))


def reachable(nodes: DataFrame) -> DataFrame:
    """``(file, at)`` of the ``nodes(file, block, at, next)`` that a file's chain of
    successors reaches from place 0.

    Most candidates are followed by their successor, so consecutive ones are first
    taken together as runs within their split. Pointer jumping over the runs doubles
    the reach of every pointer each round.
    """
    inside = Window.partitionBy("file", "block").orderBy("at")
    follows = F.lag("next").over(inside).eqNullSafe(F.col("at"))
    head = F.max(F.when(~F.col("follows"), F.col("at"))).over(inside)
    runs = nodes.select("file", "block", "at", "next").withColumn("follows", follows)
    runs = stored(runs.select("file", "at", "next", head.alias("head")), "archive-runs")
    exits = runs.groupBy("file", "head").agg(F.max_by("next", "at").alias("exit"))
    entries = runs.select("file", F.col("at").alias("exit"), F.col("head").alias("to"))
    jumps = stored(exits.join(entries, ["file", "exit"]), "archive-jumps")
    reached = runs.where("at = 0").select("file", "head")
    most = jumps.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    far = jumps.select("file", "head", "to")
    for _ in range(math.ceil(math.log2(most + 1))):
        onward = reached.join(far, ["file", "head"]).select("file", F.col("to").alias("head"))
        reached = stored(reached.union(onward).distinct(), "archive-reached")
        again = far.select("file", F.col("head").alias("to"), F.col("to").alias("then"))
        far = stored(
            far.join(again, ["file", "to"]).select("file", "head", F.col("then").alias("to")),
            "archive-jumps",
        )
    entered = jumps.join(reached, ["file", "head"]).select(
        "file", F.col("to").alias("head"), F.col("exit").alias("from")
    )
    first = runs.where("at = 0").select("file", "head", F.lit(0).cast("long").alias("from"))
    entered = entered.union(first)
    return runs.join(entered, ["file", "head"]).where("at >= from").select("file", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``.

    Rows ``record_id`` (null where the record has no number), ``url``, ``record_type``,
    ``refers_to``, ``payload_bytes`` and ``payload_digest`` (bare SHA-1). For records
    that carry their payload, both come from the payload as read; for others, from the
    header. A chain that leads nowhere ends there: a cut-off file gives the records
    before the cut.
    """
    found = stored(candidates(spark, path), "archive-candidates")
    real = reachable(found).withColumn("real", F.lit(True))
    marked = found.join(real, ["file", "at"], "left")
    records = marked.where("real")
    own = records.where("sha1 IS NULL AND length IS NOT NULL")
    if not own.isEmpty():
        whole = _joined_payloads(spark, path, marked, own)
        records = records.drop("sha1").join(
            records.select("file", "at", "sha1").where("sha1 IS NOT NULL").union(whole),
            ["file", "at"],
            "left",
        )
    revisit = F.col("type") == "revisit"
    said = F.regexp_extract("digest", "^sha1:(.*)$", 1)
    return records.select(
        _number("record").alias("record_id"),
        "url",
        F.col("type").alias("record_type"),
        _number("refers").alias("refers_to"),
        F.when(revisit, F.col("full").cast("long"))
        .otherwise(F.col("length"))
        .alias("payload_bytes"),
        F.when(revisit, said).otherwise(F.col("sha1")).alias("payload_digest"),
    )


def _joined_payloads(
    spark: SparkSession, path: str, marked: DataFrame, own: DataFrame
) -> DataFrame:
    """``(file, at, sha1)`` of records whose payload holds a record's first line.

    Such a payload came in pieces: the record's own and those of the candidates up to
    the next record, with that line between them. Their texts are read again and found
    by their SHA-256, as how a second read splits and numbers the files depends on the
    executors there are by then.
    """
    so_far = Window.partitionBy("file").orderBy("at")
    owner = F.last(F.when(F.col("real"), F.col("at")), ignorenulls=True).over(so_far)
    pieces = marked.select("file", "at", "content", owner.alias("owner")).join(
        own.select("file", F.col("at").alias("owner"), "start", "length"), ["file", "owner"]
    )
    pieces = stored(pieces, "archive-pieces")
    lots = F.ceil(F.count("*") / PIECES_PER_TEXT).cast("int").alias("lots")
    needed = pieces.groupBy("content").agg(lots)
    texts = (
        _lines(spark, path)
        .select(F.unhex(F.sha2("value", 256)).alias("content"), "value")
        .join(needed, "content")
        .dropDuplicates(["content"])
        .select("content", "value", F.explode(F.expr("sequence(0, lots - 1)")).alias("lot"))
    )
    lot = F.pmod(F.xxhash64("file", "at"), F.coalesce("lots", F.lit(1))).cast("int")
    joined = (
        with_salted(pieces, needed.where("lots > 1"), "content")
        .withColumn("lot", lot)
        .join(texts, ["content", "lot"])
        .groupBy("file", "owner", "start", "length")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("pieces"))
        .withColumn("text", F.array_join("pieces.value", MAGIC))
    )
    payload = F.expr("substring(cast(text AS binary), start + 1, int(length))")
    whole = F.octet_length("text") >= F.col("start") + F.col("length")
    return joined.where(whole).select("file", F.col("owner").alias("at"), F.sha1(payload).alias("sha1"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The texts between first lines of records, and where they were read."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def _number(name: str) -> Column:
    found = F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(found != "", found.cast("long"))


ship(__name__)
