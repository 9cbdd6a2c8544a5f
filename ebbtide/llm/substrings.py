"""Passages that repeat across documents, found with compressed full-text indexes.

A window is a run of consecutive words. The least hash of the short word sequences in
it decides the shard that looks at it, so equal windows meet in one shard and windows
whose least hash occurs in one document only are never looked at. A shard indexes its
passages (an FM-index over wavelet trees) and streams them against the index; matches
as long as a window report the least document that holds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.fmindex import Index
from ebbtide.llm.shared import known, ship, stored, with_salted, word_numbers

WINDOW = 50
# Words in the short sequences whose hashes name a window's shard.
GRAM = 8
# Windows one passage holds at most; longer runs are cut.
RUN = 64
# Different passages one shard key may bring together, which one index must hold (under
# a million words); beyond, each window goes by its
# own hash.
MEETING = 8000
INDEXED_WORDS = 300_000
_COMBINED_BYTES = 16 << 20
_LAST = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_MIX), -1, 1 << 64))


def _least_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """For each window the least hash of its sequences of ``GRAM`` words (shorter in
    shorter windows)."""
    size = min(GRAM, window)
    grams = words
    for i in range(1, size):
        grams = grams[: len(words) - i] * _MIX + words[i:]
    grams = (grams ^ (grams >> np.uint64(31))) * _MIX
    least, span, wanted = grams, 1, window - size + 1
    while span < wanted:
        step = min(span, wanted - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least.view(np.int64)


def _runs(words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows with the same least hash, cut to ``RUN``: the hash,
    the first window, the number of windows, and a hash of the run's words."""
    if len(words) < window:
        return (np.empty(0, np.int64),) * 4
    least = _least_hashes(words, window)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
    sizes = np.diff(starts, append=len(least))
    parts = -(-sizes // RUN)
    first = np.repeat(starts, parts)
    nth = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
    first += nth * RUN
    count = np.minimum(np.repeat(starts + sizes, parts) - first, RUN)
    # A sum of words times powers, moved back by the power of the first place.
    powers = np.cumprod(np.full(len(words), _MIX)) * _BACK
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers, dtype=np.uint64)])
    backs = np.cumprod(np.full(len(words), _BACK)) * _MIX
    content = (sums[first + count + window - 1] - sums[first]) * backs[first]
    return least[first], first, count, content.view(np.int64)


def _examined(docs: DataFrame, window: int) -> DataFrame:
    """Words, digest of the words, and runs of every row of ``docs(rank, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column(1).to_pylist():
                data = text.encode()
                words = data.split()
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                numbers = word_numbers(np.frombuffer(b" " + data + b" ", np.uint8))
                found.append(_runs(numbers, window))
            offsets = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])])
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.array(np.concatenate([f[i] for f in found] or [[]]), kind),
                )
                for i, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), *lists],
                ["rank", "n_words", "sha", "keys", "starts", "sizes", "contents"],
            )

    return docs.mapInArrow(
        run,
        "rank long, n_words long, sha binary, keys array<long>, starts array<int>,"
        " sizes array<int>, contents array<long>",
    )


def _passages(row: dict, window: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Key, first window, number of windows and words of the passages of a document."""
    import xxhash

    words = row["text"].encode().split()
    for span in row["spans"]:
        start, size = span["start"], span["size"]
        if span["crowded"]:
            for at in range(start, start + size):
                data = b" ".join(words[at : at + window])
                key = xxhash.xxh64_intdigest(data)
                yield key - ((key >> 63) << 64), at, 1, data
        else:
            yield span["key"], start, size, b" ".join(words[start : start + size + window - 1])


def _name(key: int, words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16, key=key.to_bytes(8, signed=True)).digest()


def _texts(rows: DataFrame, window: int) -> DataFrame:
    """The passages ``key, words`` with the least and the greatest document of each,
    copies combined where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], tuple[int, int]] = {}
        size = 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in held], pa.int64()),
                    pa.array([w for _, w in held], pa.binary()),
                    pa.array([low for low, _ in held.values()], pa.int64()),
                    pa.array([high for _, high in held.values()], pa.int64()),
                ],
                ["key", "words", "low", "high"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                rank = row["rank"]
                for key, _, _, words in _passages(row, window):
                    low, high = held.get((key, words), (rank, rank))
                    if low == high == rank:
                        size += len(words) + 100
                    held[key, words] = min(low, rank), max(high, rank)
                if size > _COMBINED_BYTES:
                    yield flushed()
                    held, size = {}, 0
        yield flushed()

    return rows.mapInArrow(run, "key long, words binary, low long, high long")


def _members(rows: DataFrame, window: int) -> DataFrame:
    """Which documents hold which passages, and where."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (row["rank"], row["sha"], start, _name(key, words))
                for row in batch.to_pylist()
                for key, start, _, words in _passages(row, window)
            ]
            columns = list(zip(*found, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["rank", "sha", "start", "name"],
            )

    return rows.mapInArrow(run, "rank long, sha binary, start int, name binary")


def _matched(texts: DataFrame, window: int) -> DataFrame:
    """For each passage with a window that an earlier document holds, ``name`` and the
    least document of each of its windows."""

    def search(held: dict[tuple[int, bytes], tuple[int, int]]) -> pa.RecordBatch:
        vocabulary: dict[bytes, int] = {}
        numbers, sizes = [], []
        for _, words in held:
            split = words.split()
            sizes.append(len(split))
            numbers.append(0)
            numbers.extend([vocabulary.setdefault(w, len(vocabulary) + 1) for w in split])
        bounds = np.array(list(held.values()), np.int64).reshape(-1, 2)
        sizes = np.array(sizes, np.int64)
        text = np.array(numbers, np.int64)
        starts = np.cumsum(sizes + 1) - sizes
        index = Index(text, np.repeat(bounds[:, 0], sizes + 1), window)
        least = index.least_owners(text, starts, sizes)
        names, owners = [], []
        for (key, words), start, size, high in zip(held, starts, sizes, bounds[:, 1], strict=True):
            own = least[start : start + size - window + 1]
            if own.min() < high:
                names.append(_name(key, words))
                owners.append(own)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(owners, pa.list_(pa.int64()))],
            ["name", "owners"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive in the order of their keys; an index ends between two keys.
        held: dict[tuple[int, bytes], tuple[int, int]] = {}
        count, last = 0, None
        for batch in batches:
            for key, words, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last and count >= INDEXED_WORDS:
                    yield search(held)
                    held, count = {}, 0
                last = key
                before = held.get((key, words))
                if before is None:
                    count += words.count(b" ") + 2
                    held[key, words] = low, high
                else:
                    held[key, words] = min(low, before[0]), max(high, before[1])
        if held:
            yield search(held)

    ordered = texts.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "name binary, owners array<long>")


def _shortened(rows: DataFrame, window: int) -> DataFrame:
    """``n_removed`` and the digest of the words left, from ``rows(rank, sha, text,
    found)`` where ``found`` has the passages' first windows and least documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests = [], []
            for row in batch.to_pylist():
                words = row["text"].encode().split()
                covered = np.zeros(len(words) + 1, np.int64)
                for found in row["found"]:
                    at = found["start"] + np.flatnonzero(np.array(found["owners"]) < row["rank"])
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + window, -1)
                gone = np.cumsum(covered[:-1]) > 0
                removed.append(int(gone.sum()))
                left = b" ".join([w for w, g in zip(words, gone, strict=True) if not g])
                digests.append(hashlib.sha256(left).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                ["rank", "sha", "n_removed", "kept_sha"],
            )

    return rows.mapInArrow(run, "rank long, sha binary, n_removed long, kept_sha binary")


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``id, n_words, n_removed, kept_sha`` of every row of ``docs``: the words of each
    document without those in a window whose words also start in a document with a
    smaller id.

    Words are separated by ASCII white space; null texts have none. Windows are judged
    on the texts as given. Null ids come after all others, and documents of one id
    remove nothing from each other, so rows that repeat have the same result. An empty
    table gives no rows; other columns are not read.
    """
    rank = F.coalesce(F.col(key).cast("long"), F.lit(_LAST))
    given = docs.select(rank.alias("rank"), known(F.col(text)).alias("text"))
    rows = stored(_examined(given, window), "windows")
    # Of documents with the same words, all but the first go whole.
    copies = (
        rows.where(F.col("n_words") >= window)
        .groupBy("sha")
        .agg(F.min("rank").alias("least"), F.count("*").alias("times"))
        .where("times > 1")
        .drop("times")
    )
    rows = with_salted(rows, copies, "sha")
    first = rows.where("least IS NULL OR rank = least")
    runs = first.select(
        "rank", "sha", F.explode(F.arrays_zip("keys", "starts", "sizes", "contents")).alias("run")
    ).select("rank", "sha", F.col("run.keys").alias("key"), "run.starts", "run.sizes", "run.contents")
    runs = stored(runs, "runs")
    shared = (
        runs.groupBy("key", "contents")
        .agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
        .groupBy("key")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("texts"))
        .where("low < high")
        .select("key", (F.col("texts") > MEETING).alias("crowded"))
    )
    span = F.struct(F.col("starts").alias("start"), F.col("sizes").alias("size"), "key", "crowded")
    spans = runs.join(shared, "key").groupBy("rank", "sha").agg(F.collect_list(span).alias("spans"))
    held = stored(_with_text(given, spans), "passages")
    matched = _matched(_texts(held.select("rank", "text", "spans"), window), window)
    found = (
        _members(held, window)
        .join(matched, "name")
        .groupBy("rank", "sha")
        .agg(F.collect_list(F.struct("start", "owners")).alias("found"))
    )
    texts = held.select("rank", "sha", "text")
    shortened = _shortened(
        texts.join(found, ["rank", "sha"]).select("rank", "sha", "text", "found"), window
    )
    copy = F.col("least") < F.col("rank")
    nothing = F.unhex(F.sha2(F.lit(""), 256))
    return (
        rows.select("rank", "sha", "n_words", "least")
        .join(shortened, ["rank", "sha"], "left")
        .select(
            F.when(F.col("rank") != _LAST, F.col("rank")).alias("id"),
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, nothing).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha"),
        )
    )


def _with_text(given: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts of the documents in ``spans``; one of rows that repeat. Documents of
    one id are told apart by the digest of their words."""
    squeezed = F.regexp_replace(F.regexp_replace("text", r"[ \t-\r]+", " "), r"^ | \z", "")
    digested = given.withColumn("sha", F.unhex(F.sha2(squeezed, 256)))
    one = F.row_number().over(Window.partitionBy("rank", "sha").orderBy("rank"))
    found = digested.join(spans, ["rank", "sha"]).withColumn("nth", one)
    return found.where("nth = 1").drop("nth")


ship(__name__)
