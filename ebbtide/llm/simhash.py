"""Near-duplicate documents by SimHash fingerprints and tables of pivot distances.

Two fingerprints that differ in at most three bits agree on at least three of six bit
fields, so they meet in one of the 20 blocks that fix three fields; no other pairs are
looked at. In a block, each fingerprint's distances to many reference fingerprints are
known. Pairs whose distances to one reference differ by more than the limit cannot be
linked (the triangle inequality) and are discarded; the survivors are verified bit by
bit. A block gives the links of a spanning forest, never all pairs of a dense group.
Large blocks are split by more fields until all are small.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.graph import components
from ebbtide.llm.shared import known, ship, stored, with_facts, with_salted

SHINGLE = 3
DISTANCE = 3
SEED = 42
PIVOTS = 24
# A block of more distinct fingerprints is split; at least 8.
MOST_BLOCK = 10_000
# Large blocks whose numbers are broadcast; more are joined by salted shuffles.
BROADCAST_BLOCKS = 100_000
# Lowest bit and width of each field: as many fields differ at most as bits may.
_FIELDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))


def fingerprints_of(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers. Lower-cases A-Z only; words are separated
    by ASCII white space; a text with fewer words than a shingle is one shingle, one
    without words has fingerprint zero."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    places = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, text in enumerate(texts):
        words = text.encode().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = list(itertools.accumulate([len(word) + 1 for word in words]))
        if len(words) <= shingle:
            hashes = [digest(joined, SEED)]
        else:
            starts = [0, *ends]
            hashes = [
                digest(joined[s : e - 1], SEED)
                for s, e in zip(starts, ends[shingle - 1 :], strict=False)
            ]
        numbers = np.array(hashes, np.uint64)
        ones = np.zeros(64, np.int64)
        for first in range(0, len(numbers), 4096):
            part = numbers[first : first + 4096].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = places[ones * 2 > len(numbers)].sum(dtype=np.uint64)
    return out.view(np.int64)


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``(id, fp, sha)`` of every row, the last the SHA-256 of its text; null texts count
    as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(batch.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), batch.column(2)], ["id", "fp", "sha"]
            )

    return docs.select(
        F.col(key).cast("long").alias("id"),
        known(F.col(text)).alias("text"),
        _sha(text).alias("sha"),
    ).mapInArrow(run, "id long, fp long, sha binary")


def _sha(text: str) -> Column:
    return F.unhex(F.sha2(known(F.col(text)), 256))


def pivot_table(values: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Distances of fingerprints to the reference fingerprints, one row each."""
    references = np.random.default_rng(20).integers(0, 2**63, pivots, np.int64) * 2 + 1
    found = np.bitwise_count(values.view(np.uint64)[:, None] ^ references.view(np.uint64))
    return found.astype(np.int16)


def block_links(values: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, each as (least of
    its tree, other).

    Trees grow breadth-first. Fingerprints not reached yet are kept in the order of
    their distance to the first pivot, so that a search sees those within ``distance``
    of it there, and drops by the other pivots before it compares bits.
    """
    coordinates = pivot_table(values)
    order = np.argsort(coordinates[:, 0], kind="stable")
    bits = values.view(np.uint64)
    free = np.ones(len(values), bool)
    first = coordinates[order, 0]
    links = []
    for seed in np.argsort(values, kind="stable"):
        if not free[seed]:
            continue
        free[seed] = False
        waiting = [seed]
        while waiting:
            at = waiting.pop()
            own = coordinates[at]
            low = np.searchsorted(first, own[0] - distance, "left")
            high = np.searchsorted(first, own[0] + distance, "right")
            near = order[low:high]
            near = near[free[near]]
            if not len(near):
                continue
            near = near[(np.abs(coordinates[near] - own) <= distance).all(1)]
            near = near[np.bitwise_count(bits[near] ^ bits[at]) <= distance]
            free[near] = False
            waiting.extend(near)
            links.extend((int(values[seed]), int(values[other])) for other in near)
        if len(first) > 64 and free[order].mean() < 0.5:
            order = order[free[order]]
            first = coordinates[order, 0]
    return links


def _links_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive sorted; one that goes on in the next batch waits for it."""
    rest_key, rest_fp = np.empty(0, np.int64), np.empty(0, np.int64)

    def found(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.diff(keys)) + 1
        bounds = np.concatenate([[0], edges, [len(keys)]])
        sizes = np.diff(bounds)
        links = []
        for start, size in zip(bounds[:-1][sizes > 1], sizes[sizes > 1], strict=True):
            links.extend(block_links(values[start : start + size]))
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"]
        )

    for batch in batches:
        keys = np.concatenate([rest_key, batch.column(0).to_numpy()])
        values = np.concatenate([rest_fp, batch.column(1).to_numpy()])
        done = np.searchsorted(keys, keys[-1], "left") if len(keys) else 0
        if done:
            yield found(keys[:done], values[:done])
        rest_key, rest_fp = keys[done:], values[done:]
    if len(rest_key):
        yield found(rest_key, rest_fp)


def finer_masks(mask: int) -> list[int]:
    """``mask`` with each of four parts of its free bits fixed too. Fingerprints that
    differ in at most three bits agree on one of the parts at least."""
    free = [1 << bit for bit in range(64) if not mask >> bit & 1]
    masks = [(mask & (1 << 64) - 1) | sum(free[part::4]) for part in range(4)]
    return [m - (m >> 63 << 64) for m in masks]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        block, mask, fp = (column.to_numpy() for column in batch.columns)
        masks, which = np.unique(mask, return_inverse=True)
        finer = np.array([finer_masks(int(m)) for m in masks], np.int64).reshape(-1, 4)
        finer = finer[which].reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(block, 4)), pa.array(finer), pa.array(np.repeat(fp, 4))],
            ["block", "mask", "fp"],
        )


def _blocks(values: DataFrame) -> DataFrame:
    """``(block, fp)``: every two fingerprints that differ in at most three bits meet in
    a block, and none holds more than ``MOST_BLOCK``."""
    chosen_masks = []
    for n, chosen in enumerate(itertools.combinations(_FIELDS, 3)):
        mask = sum(((1 << width) - 1) << low for low, width in chosen)
        mask -= (mask >> 63) << 64
        key = F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(mask)))
        chosen_masks.append(F.struct(key.alias("block"), F.lit(mask).alias("mask")))
    blocks = values.select(F.explode(F.array(*chosen_masks)).alias("b"), "fp").select(
        "b.block", "b.mask", "fp"
    )
    small = None
    while True:
        sizes = blocks.groupBy("block").agg(F.count("*").alias("size"))
        large = stored(
            sizes.where(F.col("size") > MOST_BLOCK).select("block", F.lit(True).alias("large")),
            "large-blocks",
        )
        count = large.count()
        if count and count <= BROADCAST_BLOCKS:
            blocks = blocks.join(F.broadcast(large), "block", "left")
        elif count:
            blocks = with_salted(blocks, large, "block")
        fit = (blocks.where("large IS NULL") if count else blocks).select("block", "fp")
        small = fit if small is None else small.union(fit)
        if not count:
            return small
        # Every round fixes a quarter of the free bits, so the rounds are few.
        split = blocks.where("large").select("block", "mask", "fp")
        split = split.mapInArrow(_split, "block long, mask long, fp long")
        key = F.xxhash64("block", "mask", F.col("fp").bitwiseAND(F.col("mask")))
        blocks = stored(split.withColumn("block", key), "split-blocks")


def links(values: DataFrame) -> DataFrame:
    """Links ``(a, b)`` among the distinct fingerprints ``fp`` that connect all that
    differ in at most three bits."""
    blocks = _blocks(values).repartition("block").sortWithinPartitions("block")
    return blocks.mapInArrow(_links_of_blocks, "a long, b long")


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """``(id, fp, component_id)`` of every row of ``docs``.

    Documents whose fingerprints differ in at most three bits are linked; the component
    id is the least id that can be reached, the document itself included. Null texts
    count as empty; texts without words have fingerprint zero and link like others.
    Null ids are reported but give no component id; rows that repeat an id are each
    reported. An empty table gives no rows. Other columns are not read.
    """
    return _grouped(docs, key, text, shingle).select("id", "fp", "component_id")


def _grouped(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``(id, fp, sha, root, component_id)`` of every row; the root tells components
    without an id apart."""
    rows = stored(fingerprints(docs, key, text, shingle), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = with_facts(rooted, smallest, "root").select("fp", "root", "component_id")
    return with_facts(rows, named, "fp").select("id", "fp", "sha", "root", "component_id")


def one_of_each_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component, with all their
    columns; of rows that repeat an id, all whose text is in that component. Of a
    component without any id the row whose text has the least SHA-256 stays, one if
    several have that text; other rows without an id go."""
    names = docs.columns
    groups = _grouped(docs, key, text, shingle)
    whole = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        F.col(key).cast("long").alias("id"),
        _sha(text).alias("sha"),
    )
    kept = groups.where("id = component_id").select("id", "sha").distinct()
    left = whole.join(kept, ["id", "sha"], "left_semi").select("row")
    nameless = whole.where("id IS NULL")
    if not nameless.isEmpty():
        alone = groups.where("component_id IS NULL").groupBy("root").agg(F.min("sha").alias("sha"))
        once = F.row_number().over(Window.partitionBy("sha").orderBy(F.lit(1)))
        left = left.union(
            nameless.join(alone, "sha", "left_semi")
            .withColumn("nth", once)
            .where("nth = 1")
            .select("row")
        )
    return left.select("row.*")


ship(__name__)
