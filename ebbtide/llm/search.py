"""Ranked search of a query set over all documents, part by term, part by document.

The query set is taken in blocks whose terms are bounded. One pass over the texts keeps,
for each document, how often it holds the terms of the block. A second pass searches
these postings in shards: for every query the short lists of a shard are summed by term
into accumulators, and the accumulators are then one more list, with its greatest sum as
its bound, beside the long lists in a document-at-a-time search. Lists whose bounds
together cannot reach the score of the last place are not walked; they are only looked
up for the documents that the others bring and that could still reach it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, ship, stored

TOP = 20
# Queries searched together: as many as these, or as fill this many bytes of text.
BLOCK_ITEMS = 1000
BLOCK_BYTES = 1 << 20
# A shard ends at this many documents or postings.
SHARD_ROWS = 16_384
SHARD_POSTINGS = 2_000_000
# Lists up to this share of a shard's documents are summed into accumulators.
SHORT_SHARE = 1 / 64
# Documents that the long lists are walked by at a time.
WINDOW = 2048
# Texts of more bytes are counted match by match, without a list of all.
_LONG_TEXT = 8 << 20
# The characters that are not separators, as bytes of UTF-8.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def term_counts(text: str) -> Counter[bytes]:
    """How often each term occurs: the longest runs of characters other than ASCII
    controls, blanks and punctuation, with only A-Z lower-cased."""
    data = text.encode().lower()
    if len(data) <= _LONG_TEXT:
        return Counter(_TERM.findall(data))
    return Counter(match.group() for match in _TERM.finditer(data))


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter[bytes]]]]:
    """The items in blocks, each with its terms; items without terms find nothing."""
    block, size = [], 0
    for row in items.toLocalIterator():
        terms = term_counts(row.text)
        if not terms:
            continue
        if block and (len(block) >= BLOCK_ITEMS or size + len(row.text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row.id, terms))
        size += len(row.text)
    if block:
        yield block


def _postings(texts: DataFrame, terms: list[bytes]) -> DataFrame:
    """``(id, n, terms, counts)`` of every document with a term: its number of terms, and
    which of ``terms`` it holds how often."""
    broadcast = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: i for i, term in enumerate(broadcast.value)}
        for batch in batches:
            ids, sizes, found, times = [], [], [], []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = term_counts(text)
                if not counts:
                    continue
                held = [(place[t], c) for t, c in counts.items() if t in place]
                ids.append(key)
                sizes.append(counts.total())
                found.append([t for t, _ in held])
                times.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                ["id", "n", "terms", "counts"],
            )

    return texts.mapInArrow(run, "id long, n long, terms array<int>, counts array<bigint>")


class Best:
    """The places of one query: the highest scores, equal ones by id, null ids last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.nameless = np.empty(0, bool)

    def least(self) -> int:
        """A document needs this score at least to get a place."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        nameless = np.concatenate([self.nameless, nameless])
        order = np.lexsort((ids, nameless, -scores))[: self.top]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]


class Shard:
    """Some documents and the postings of each term among them, as parts of scores."""

    def __init__(self, batch: pa.RecordBatch, documents: int, length: int, width: int) -> None:
        self.nameless = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        self.ids = batch.column(0).fill_null(0).to_numpy()
        sizes = batch.column(1).to_numpy()
        terms = batch.column(2).flatten().to_numpy()
        counts = batch.column(3).flatten().to_numpy()
        held = pc.list_value_length(batch.column(2)).to_numpy()
        owner = np.repeat(np.arange(len(self.ids)), held)
        order = np.argsort(terms, kind="stable")
        self.docs = owner[order]
        times = counts[order]
        norm = 75 + 25 * sizes * documents // length
        self.parts = 1_000_000_000 * times // (1000 * times + 12 * norm[self.docs])
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=width))])

    def list_of(self, term: int, weight: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.starts[term], self.starts[term + 1])
        return self.docs[own], self.parts[own] * weight


def _accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of several lists by document, as one list."""
    docs = np.concatenate([d for d, _ in lists])
    values = np.concatenate([v for _, v in lists])
    order = np.argsort(docs, kind="stable")
    docs, values = docs[order], values[order]
    first = np.flatnonzero(np.diff(docs, prepend=-1))
    return docs[first], np.add.reduceat(values, first)


def search_shard(shard: Shard, query: list[tuple[int, int]], best: Best) -> None:
    """Offer ``best`` the documents of ``shard`` that can get a place for ``query``,
    given as terms and their weights."""
    short, lists = [], []
    limit = max(1, int(len(shard.ids) * SHORT_SHARE))
    for term, weight in query:
        docs, values = shard.list_of(term, weight)
        if len(docs):
            (short if len(docs) <= limit else lists).append((docs, values))
    if short:
        lists.append(_accumulated(short))
    if not lists:
        return
    lists = sorted(lists, key=lambda pair: int(pair[1].max()))
    bounds = np.cumsum([int(values.max()) for _, values in lists])
    least = best.least()
    # Scores are no less than any list's part of them.
    for _, values in lists:
        if len(values) >= best.top:
            least = max(least, int(np.partition(values, -best.top)[-best.top]))
    for base in range(0, len(shard.ids), WINDOW):
        # Lists before ``lazy`` cannot reach a place without one of the others.
        lazy = int(np.searchsorted(bounds, least, "left"))
        if lazy == len(lists):
            return
        sums = np.zeros(WINDOW, np.int64)
        for docs, values in lists[lazy:]:
            low, high = np.searchsorted(docs, [base, base + WINDOW])
            sums[docs[low:high] - base] += values[low:high]
        rest = int(bounds[lazy - 1]) if lazy else 0
        found = np.flatnonzero(sums)
        found = found[sums[found] + rest >= least]
        scores = sums[found]
        for i in range(lazy - 1, -1, -1):
            if not len(found):
                break
            docs, values = lists[i]
            at = np.minimum(np.searchsorted(docs, found + base), len(docs) - 1)
            scores = scores + np.where(docs[at] == found + base, values[at], 0)
            able = scores + (int(bounds[i - 1]) if i else 0) >= least
            found, scores = found[able], scores[able]
        if len(found):
            best.offer(scores, shard.ids[found + base], shard.nameless[found + base])
            least = max(least, best.least())


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together or cut to shards."""
    held, rows, postings = [], 0, 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        sizes = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy())
        start = 0
        while start < len(batch):
            before = sizes[start - 1] if start else 0
            room = np.searchsorted(sizes, before + SHARD_POSTINGS - postings, "right") - start
            take = int(min(room, SHARD_ROWS - rows, len(batch) - start))
            if take <= 0 and held:
                yield joined()
                held, rows, postings = [], 0, 0
                continue
            take = max(1, take)
            held.append(batch.slice(start, take))
            rows, postings = rows + take, postings + int(sizes[start + take - 1] - before)
            start += take
    if held:
        yield joined()


def _search_block(
    texts: DataFrame, block: list[tuple[int | None, Counter[bytes]]], top: int
) -> DataFrame:
    spark = texts.sparkSession
    terms = sorted({term for _, counts in block for term in counts})
    postings = stored(_postings(texts, terms), "postings")
    totals = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    documents, length = totals.documents, totals.length or 0
    # At most one row per term of the block.
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = {
        row.term: math.floor(1000 * math.log((2 * documents + 2) / (2 * row["count"] + 1)))
        for row in held
    }
    place = {term: i for i, term in enumerate(terms)}
    queries = [
        [
            (place[t], c * weights[place[t]])
            for t, c in counts.items()
            if weights.get(place[t], 0) > 0
        ]
        for _, counts in block
    ]
    width = len(terms)
    broadcast = spark.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = broadcast.value
        places = [Best(top) for _ in queries]
        for batch in _shards(batches):
            shard = Shard(batch, documents, length, width)
            for query, best in zip(queries, places, strict=True):
                search_shard(shard, query, best)
        for item, best in enumerate(places):
            if len(best.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(best.scores), item, np.int32)),
                        pa.array(best.ids, mask=best.nameless),
                        pa.array(best.scores),
                    ],
                    ["item", "doc_id", "score"],
                )

    found = postings.mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = [(i, key) for i, (key, _) in enumerate(block)]
    named = F.broadcast(spark.createDataFrame(names, "item int, item_id long"))
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items`` the ``top`` documents
    with the highest scores above 0, from rank 1 on.

    Equal scores go by id; documents without an id come last and are given as null. Rows
    that repeat an id, or a text, are documents (or items) of their own. Null and empty
    texts have no terms: as documents they count in no statistic, as items they find
    nothing. Very long texts are read whole; scores are right up to 64 bits, that is
    while 25 times a document's terms times the number of documents stays below 2^63.
    An empty table gives no rows. Other columns are not read.

    Items are taken through the driver in blocks of at most ``BLOCK_ITEMS`` or
    ``BLOCK_BYTES`` (or one longer item); a block's terms are broadcast, and documents
    are read once per block.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text")
    )
    asked = items.select(
        F.col(item_key).cast("long").alias("id"), known(F.col(item_text)).alias("text")
    )
    answers = None
    for block in _blocks(asked):
        answer = stored(_search_block(texts, block, top), "ranked")
        answers = answer if answers is None else answers.union(answer)
    if answers is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return answers


ship(__name__)
