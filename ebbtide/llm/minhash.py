"""Near-duplicate documents by bottom-k sketches, inverted lists and exact Jaccard.

One hash function numbers the shingles of a document; its sketch is the least of these
numbers. A number that several sketches retain makes an inverted list. Documents are
entered only under the rarest of their numbers, as many as two similar documents need to
be sure to meet, so that common lines and passages make no lists. In a list the
overlaps of all sketches are one matrix product. Sketches that hold whole sets settle a
pair at once; for others the sketch of the union estimates it, and the full sets verify.

Lists propose links as spanning forests of what is not connected yet, so a family of
similar documents gives about as many links as it has members. Lists of any length are
cut into blocks; what blocks cannot settle at once is looked at again in later rounds.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.graph import components
from ebbtide.llm.shared import known, only, ship, stored, with_facts

SHINGLE = 4
SEED = 42
# Least similarity, in hundredths.
PERCENT = 80
# Numbers that a sketch retains, and the least ones of them that every document is
# indexed by. Documents that meet in crowded lists are indexed by all.
RETAINED = 512
INDEXED = 32
# Chance that two documents of just that similarity miss each other in a step.
MISS = 1e-9
# Members of a block. Longer lists are cut.
MOST_BLOCK = 256
HUBS = 64
# Times that inverted lists are merged with others of much the same members.
MERGES = 2
# A list is a family's if one component has one in so many of its members.
FAMILY = 3


def shares_of_unions(most: int) -> np.ndarray:
    """For 0 to ``most`` numbers of a union, how many of them two similar sets share at
    least, but for a chance of ``MISS``."""
    p = PERCENT / 100
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, most + 1)))])
    least = np.zeros(most + 1, np.int64)
    for size in range(1, most + 1):
        k = np.arange(size + 1)
        chance = logs[size] - logs[k] - logs[size - k] + k * np.log(p) + (size - k) * np.log(1 - p)
        least[size] = np.searchsorted(np.cumsum(np.exp(chance)), MISS, "right")
    return least


def least_shared(size: int) -> int:
    return int(shares_of_unions(size)[size])


def shingle_numbers(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The numbers of a text's distinct shingles, sorted. Lower-cases A-Z only; words are
    separated by ASCII white space; a text with fewer words is one shingle, one without
    words has none."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate([len(word) + 1 for word in words]))
    starts = [0, *ends]
    found = {
        digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=False)
    }
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def _node(numbers: np.ndarray) -> bytes | None:
    """Names a set; null for the empty one, which is like nothing."""
    import hashlib

    return hashlib.blake2b(numbers.tobytes(), digest_size=16).digest() if len(numbers) else None


def sketches(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``(id, node, n, sketch)``: the name and size of each row's set of shingles, and its
    least numbers in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_numbers(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([_node(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists([s[:RETAINED] for s in sets]),
                ],
                ["id", "node", "n", "sketch"],
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text"))
    return rows.mapInArrow(run, "id long, node binary, n long, sketch array<bigint>")


def _lists(numbers: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, numbers)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.uint64), *numbers]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _entries(numbers: DataFrame, retained: int) -> DataFrame:
    """``(node, v, df, own)``: the numbers that a node has to be listed under, of its
    numbers ``(node, n, v)``; ``df`` nodes have the number ``v``, and ``own`` of the
    node's numbers are no other node's.

    Numbers are ordered by how many nodes have them. Two similar nodes share one within
    the first few of both, as they share so many in all. Sets of which all possible
    partners are whole in their numbers share ``PERCENT`` hundredths for certain.
    """
    counts = numbers.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    counts = stored(counts, "number-counts")
    sizes = counts.select("v", F.col("df").alias("rows"))
    shared = with_facts(numbers, counts, "v", "inner", sizes=sizes)
    held = F.sort_array(F.collect_list(F.struct("df", "v"))).alias("held")
    nodes = shared.groupBy("node").agg(F.max("n").alias("n"), held)
    count = F.least("n", F.lit(retained))
    own = (count - F.size("held")).cast("int")
    certain = F.floor((F.col("n") * PERCENT + 99) / 100)
    least = F.when(F.col("n") * 100 <= retained * PERCENT, certain)
    least = least.otherwise(F.lit(least_shared(retained)))
    taken = (count - least + 1 - own).cast("int")
    return (
        nodes.withColumn("taken", taken)
        .where("taken > 0")
        .select("node", own.alias("own"), F.explode(F.slice("held", F.lit(1), F.col("taken"))))
        .select("node", "col.v", "col.df", "own")
    )


def _of_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, n, sketch)`` of the stored ``nodes``."""
    of_rows = only(rows.select("node", "n", "sketch"), nodes, "node")
    return of_rows.groupBy("node").agg(F.max("n").alias("n"), F.first("sketch").alias("sketch"))


def _judged(long: DataFrame, rows: DataFrame) -> DataFrame:
    """``(v, node, own, family)`` of the stored crowded lists ``(v, node, own, size)``,
    merged; and whether a family of near copies has much of the list, as far as the
    members beside the hubs tell."""
    merged = long
    for salt in range(MERGES):
        merged = stored(_merged(merged, salt), "crowded-lists")
    nodes = stored(merged.select("node").distinct(), "crowded-nodes")
    blocks = _around_hubs(merged.withColumn("comp", F.col("node")))
    blocks = blocks.join(stored(_of_nodes(rows, nodes), "crowded-facts"), "node")
    blocks = blocks.withColumn("refused", F.lit(None).cast("array<binary>"))
    roots = components(_propose(blocks, 1).select("a", "b"))
    rooted = with_facts(merged, roots, "node").where("root IS NOT NULL")
    parts = rooted.groupBy("v", "size", "root").agg(F.count("*").alias("rows"))
    much = parts.where(FAMILY * F.col("rows") >= F.col("size")).select("v").distinct()
    much = stored(much.withColumn("family", F.lit(True)), "family-lists")
    judged = with_facts(merged, much, "v")
    return judged.select("v", "node", "own", F.col("family").isNotNull().alias("family"))


def _members(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """``(v, size, node, own)``: the inverted lists. Of lists with the same members one is
    kept, and lists with much the same are merged.

    Two documents that meet in a crowded list are compared in it if it is a family's, as
    more numbers would make more lists of the same members. Otherwise both are listed
    again by all numbers.
    """
    numbers = classes.select("node", "n", F.explode("first").alias("v"))
    entries = stored(_entries(stored(numbers, "numbers"), INDEXED), "entries")
    lists = entries.where(F.col("df") <= MOST_BLOCK).select("v", "node", "own")
    long = entries.where(F.col("df") > MOST_BLOCK).withColumnRenamed("df", "size")
    long = stored(long, "crowded")
    if not long.isEmpty():
        judged = stored(_judged(long, rows), "judged-lists")
        families = judged.where("family").select(F.xxhash64("v", F.lit(2)), "node", "own")
        again = stored(judged.where("NOT family").select("node").distinct(), "listed-again")
        every = _of_nodes(rows, again).select("node", "n", F.explode("sketch").alias("v"))
        every = _entries(stored(every, "all-numbers"), RETAINED)
        every = every.select(F.xxhash64("v", F.lit(1)), "node", "own")
        lists = lists.union(families).union(every)
    lists = stored(lists, "lists")
    sizes = lists.groupBy("v").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    sizes = stored(sizes, "list-sizes")
    chosen = sizes.where("size > 1").groupBy("size", "one", "two").agg(F.min("v").alias("v"))
    counted = sizes.select("v", F.col("size").alias("rows"))
    members = with_facts(lists, chosen.select("v", "size"), "v", "inner", sizes=counted)
    for salt in range(MERGES):
        members = _merged(stored(members, "members"), salt)
    return members


def _merged(members: DataFrame, salt: int) -> DataFrame:
    """Stored inverted lists with much the same members as one.

    Two lists agree on the member with the least hash as often as they share members. Lists
    that do are one list of all their members, unless that is longer than a block and than
    twice the longest of them. No two members of a list part, and no row is added.
    """
    least = members.groupBy("v").agg(
        F.max("size").alias("size"), F.min(F.xxhash64("node", F.lit(salt + 5))).alias("least")
    )
    least = stored(least, "least-members")
    several = least.groupBy("least").agg(F.count("*").alias("lists")).where("lists > 1")
    alike = least.join(several, "least", "left_semi").select("v", "least")
    counted = least.select("v", F.col("size").alias("rows"))
    alike = with_facts(members, stored(alike, "like-lists"), "v", "inner", sizes=counted)
    unions = alike.groupBy("least", "node").agg(F.max("size").alias("longest"))
    unions = unions.groupBy("least").agg(
        F.count("*").alias("both"), F.max("longest").alias("longest")
    )
    short = F.col("both") <= F.greatest(F.lit(MOST_BLOCK), 2 * F.col("longest"))
    unions = stored(unions.where(short).select("least", "both"), "unions")
    named = least.join(unions, "least", "left").select(
        "v",
        F.when(F.col("both").isNull(), F.col("v")).otherwise(F.xxhash64("least")).alias("name"),
        F.coalesce("both", "size").alias("all"),
    )
    whole = with_facts(members, stored(named, "list-names"), "v", "inner", sizes=counted)
    whole = whole.groupBy("name", "node").agg(F.max("all").alias("size"), F.min("own").alias("own"))
    return whole.select(F.col("name").alias("v"), "size", "node", "own")


def _overlaps(sketches: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """How many numbers each two sketches share."""
    owner = np.repeat(np.arange(len(filled)), filled)
    values, place, times = np.unique(sketches, return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    held = times[place] > 1
    matrix = np.zeros((len(filled), int((times > 1).sum())), np.float32)
    matrix[owner[held], column[place[held]]] = 1
    return np.rint(matrix @ matrix.T).astype(np.int64)


def _in_union(sketches: list[np.ndarray], sizes: np.ndarray, overlap: np.ndarray) -> np.ndarray:
    """How many numbers of each two sets' union the two sketches tell: all up to where the
    shorter-reaching sketch ends, all at all if both hold whole sets. The numbers that
    the sketches share are the shared ones among these."""
    last = np.iinfo(np.uint64).max
    reach = np.array(
        [last if len(s) == n else s[-1] for s, n in zip(sketches, sizes, strict=True)], np.uint64
    )
    # Numbers of the set in the row up to the reach of the set in the column.
    within = np.stack([np.searchsorted(s, reach, "right") for s in sketches])
    own = np.array([len(s) for s in sketches])
    first = reach[:, None] <= reach[None]
    return np.where(first, own[:, None] + within.T, within + own[None]) - overlap


def proposals(
    sketches: list[np.ndarray],
    sizes: np.ndarray,
    names: list[bytes],
    comps: np.ndarray,
    roles: np.ndarray,
    refused: set[tuple[bytes, bytes]],
    allowed: int,
    least: np.ndarray,
) -> list[tuple[int, int, bool]]:
    """Pairs of members that may be similar and connect what is not connected, the most
    similar first; and whether they are for certain.

    Two parts of a forest are joined by up to ``allowed`` proposals. Members with role 0
    are compared with those of role 1 only; those of role -1 with all. ``least`` is
    the table of :func:`shares_of_unions`.
    """
    filled = np.array([len(s) for s in sketches])
    overlap = _overlaps(np.concatenate(sketches), filled)
    whole = filled == sizes
    both_whole = whole[:, None] & whole[None]
    union = _in_union(sketches, sizes, overlap)
    likely = overlap >= least[np.minimum(union, len(least) - 1)]
    likely &= 100 * np.minimum(sizes[:, None], sizes) >= PERCENT * np.maximum(sizes[:, None], sizes)
    similar = np.where(both_whole, 100 * overlap >= PERCENT * union, likely)
    similar &= comps[:, None] != comps[None]
    similar &= (roles[:, None] != roles[None]) | (roles[:, None] < 0)
    first, second = np.nonzero(np.triu(similar, 1))
    share = overlap[first, second] / union[first, second]
    parent = {int(c): int(c) for c in comps}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    found, bridges = [], Counter()
    for at in np.argsort(-share, kind="stable"):
        i, j = int(first[at]), int(second[at])
        one, two = sorted((root(int(comps[i])), root(int(comps[j]))))
        if one == two or (min(names[i], names[j]), max(names[i], names[j])) in refused:
            continue
        certain = bool(both_whole[i, j])
        found.append((i, j, certain))
        bridges[one, two] += 1
        if certain or bridges[one, two] >= allowed:
            parent[two] = one
    return found


def _propose(blocks: DataFrame, allowed: int) -> DataFrame:
    """``(v, a, b, certain)``: the proposals of all blocks."""
    least = shares_of_unions(2 * RETAINED)

    def of_block(batch: pa.RecordBatch) -> list[tuple[int, bytes, bytes, bool]]:
        names = batch.column("node").to_pylist()
        others = batch.column("refused").to_pylist()
        refused = {
            (name, other) for name, own in zip(names, others, strict=True) for other in own or ()
        }
        flat = batch.column("sketch").flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(pc.list_value_length(batch.column("sketch")).to_numpy())
        codes = {}
        comps = [codes.setdefault(c, len(codes)) for c in batch.column("comp").to_pylist()]
        found = proposals(
            np.split(flat, ends[:-1]),
            batch.column("n").to_numpy(),
            names,
            np.array(comps),
            batch.column("role").to_numpy(),
            refused,
            allowed,
            least,
        )
        lists = batch.column("v").to_pylist()
        return [(lists[i], *sorted((names[i], names[j])), c) for i, j, c in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = batch.column("block").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            rows = []
            for start, end in itertools.pairwise(bounds):
                if end - start > 1:
                    rows += of_block(batch.slice(start, end - start))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            types = (pa.int64(), pa.binary(), pa.binary(), pa.bool_())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["v", "a", "b", "certain"],
            )

        rest = None
        for batch in batches:
            if not len(batch):
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = batch.column("block").to_numpy()
            done = int(np.searchsorted(keys, keys[-1], "left"))
            if done:
                yield out(batch.slice(0, done))
            rest = batch.slice(done)
        if rest is not None:
            yield out(rest)

    ordered = blocks.repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(run, "v long, a binary, b binary, certain boolean")


def _part(parts: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), parts).cast("int")


def _whole_lists(members: DataFrame) -> DataFrame:
    """``(block, v, role, node, comp)`` for lists that fit a block."""
    return members.where(F.col("size") <= MOST_BLOCK).select(
        F.xxhash64("v").alias("block"), "v", F.lit(-1).alias("role"), "node", "comp"
    )


def _around_hubs(members: DataFrame) -> DataFrame:
    """Longer lists in parts, each beside the members with the fewest numbers of their
    own: in a family of copies of one text the others are most like these."""
    long = members.where(F.col("size") > MOST_BLOCK)
    parts = F.ceil(F.col("size") / F.lit(MOST_BLOCK - HUBS)).cast("int")
    order = Window.partitionBy("v").orderBy("own", "node")
    hubs = long.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= HUBS)
    hubs = hubs.select("v", "node", "comp", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    rest = long.select("v", "node", "comp", _part(parts, 2).alias("part"))
    # A hub is in its own part twice; a node is compared with itself by no pair.
    return rest.union(hubs).distinct().select(
        F.xxhash64("v", "part").alias("block"), "v", F.lit(-1).alias("role"), "node", "comp"
    )


def _beside_largest(members: DataFrame) -> DataFrame:
    """Longer lists again: members outside the list's largest component meet all others.
    A block has two sides of half its size."""
    long = members.where(F.col("size") > MOST_BLOCK)
    counted = long.groupBy("v", "comp").agg(F.count("*").alias("rows"))
    largest = counted.groupBy("v").agg(
        F.max_by("comp", F.struct("rows", "comp")).alias("largest"),
        (F.sum("rows") - F.max("rows")).alias("minor"),
    )
    sizes = stored(long.groupBy("v").agg(F.count("*").alias("rows")), "list-rows")
    long = with_facts(long, largest, "v", "inner", sizes=sizes)
    half = F.lit(MOST_BLOCK // 2)
    rows = F.ceil(F.col("minor") / half).cast("int")
    columns = F.ceil(F.col("size") / half).cast("int")
    every = long.select(
        "v", "node", "comp", F.lit(0).alias("role"),
        F.explode(F.sequence(F.lit(0), rows - 1)).alias("row"), _part(columns, 3).alias("column"),
    )
    minor = long.where("comp <> largest").select(
        "v", "node", "comp", F.lit(1).alias("role"),
        _part(rows, 4).alias("row"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("column"),
    )
    return every.union(minor).select(
        F.xxhash64("v", "row", "column").alias("block"), "v", "role", "node", "comp"
    )


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, key: str, text: str, shingle: int
) -> DataFrame:
    """``(a, b, linked)`` of stored pairs, by the full sets of their documents."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = stored(nodes, "pair-nodes")
    ids = only(classes, nodes, "node").select(F.col("least").alias("id")).distinct()
    texts = docs.select(F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_numbers(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["node", "numbers"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * shared >= PERCENT * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    sets = only(texts, stored(ids, "pair-ids"), "id").mapInArrow(
        whole, "node binary, numbers binary"
    )
    sets = only(sets, nodes, "node").groupBy("node").agg(F.first("numbers").alias("numbers"))
    sets = stored(sets, "full-sets")
    one = sets.select(F.col("node").alias("a"), F.col("numbers").alias("one"))
    two = sets.select(F.col("node").alias("b"), F.col("numbers").alias("two"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return joined.mapInArrow(compare, "a binary, b binary, linked boolean")


def _links(
    classes: DataFrame, rows: DataFrame, docs: DataFrame, key: str, text: str, shingle: int
) -> DataFrame | None:
    """``(node, root)`` of every node with a link."""
    members = stored(_members(classes, rows), "members")
    if members.isEmpty():
        return None
    nodes = stored(members.select("node").distinct(), "member-nodes")
    facts = stored(_of_nodes(rows, nodes), "member-facts")
    refused = roots = None
    for turn in itertools.count():
        if roots is None:
            now = members.withColumn("comp", F.col("node"))
        else:
            now = members.join(roots, "node", "left")
            now = now.withColumn("comp", F.coalesce("root", "node")).drop("root")
            mixed = now.groupBy("v").agg(F.min("comp").alias("one"), F.max("comp").alias("two"))
            mixed = stored(mixed.where("one <> two").select("v"), "mixed")
            if mixed.isEmpty():
                return roots
            now = stored(only(now, mixed, "v"), "open-lists")
        blocks = _whole_lists(now)
        if not members.where(F.col("size") > MOST_BLOCK).isEmpty():
            again_long = _around_hubs if turn == 0 else _beside_largest
            blocks = blocks.union(again_long(now))
        blocks = blocks.join(facts, "node")
        if refused is None:
            blocks = blocks.withColumn("refused", F.lit(None).cast("array<binary>"))
        else:
            not_with = refused.groupBy("a").agg(F.collect_list("b").alias("refused"))
            blocks = blocks.join(not_with.withColumnRenamed("a", "node"), "node", "left")
        found = stored(_propose(blocks, 16**turn), "proposals")
        asked = stored(found.where("NOT certain").select("a", "b").distinct(), "pairs")
        new = found.where("certain").select("a", "b").distinct()
        again = members.where(F.col("size") > MOST_BLOCK).select("v") if turn == 0 else None
        if not asked.isEmpty():
            judged = stored(_verified(asked, docs, classes, key, text, shingle), "judged")
            new = new.union(judged.where("linked").select("a", "b"))
            denied = judged.where("NOT linked").select("a", "b")
            refused = denied if refused is None else refused.union(denied)
            failed = found.join(denied, ["a", "b"], "left_semi").select("v")
            again = failed if again is None else again.union(failed)
        roots = _contracted(roots, new)
        if again is None:
            return roots
        again = stored(again.distinct(), "again")
        if again.isEmpty():
            return roots
        members = stored(only(members, again, "v"), "members")


def _contracted(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(node, root)`` after more links."""
    if roots is None:
        return components(links)
    start = roots.select(F.col("node").alias("a"), F.col("root").alias("from"))
    end = start.withColumnsRenamed({"a": "b", "from": "to"})
    links = links.join(start, "a", "left").join(end, "b", "left")
    links = links.select(F.coalesce("from", "a").alias("a"), F.coalesce("to", "b").alias("b"))
    new = components(links).select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(new, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    added = new.join(roots.select(F.col("node").alias("root")), "root", "left_anti")
    moved = moved.union(added.select("root", "top"))
    return stored(moved.distinct(), "roots")


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of every row of ``docs``.

    Documents whose sets of shingles have a Jaccard similarity of 0.8 or more are linked;
    the component id is the least id that can be reached, the document itself included,
    and the document that has it is kept. Null and empty texts, and texts without words,
    have no shingles and are linked with nothing; texts with fewer words than a shingle
    are one shingle. Texts are read whole. Equal sets are one set. Null ids give no
    component id; a component without any id has a null one, and all its rows are kept.
    Rows that repeat an id are each reported. An empty table gives no rows. Other
    columns are not read.

    Links are confirmed on full sets of 64-bit numbers of shingles. A link that no other
    path replaces is missed with a chance of about ``MISS``.
    """
    rows = stored(sketches(docs, key, text, shingle), "sketches")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("least"),
        F.max("n").alias("n"),
        F.first(F.slice("sketch", 1, INDEXED)).alias("first"),
    )
    classes = stored(classes, "classes")
    roots = _links(classes, rows, docs, key, text, shingle)
    named = classes.select("node", "least")
    if roots is None:
        named = named.withColumn("root", F.col("node"))
    else:
        named = named.join(roots, "node", "left")
        named = named.withColumn("root", F.coalesce("root", "node"))
    named = stored(named, "rooted")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = with_facts(named, smallest, "root").select("node", "component_id")
    found = with_facts(rows.select("id", "n", "node"), named, "node")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        "id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


ship(__name__)
