"""Near duplicates by Jaccard similarity against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import minhash, shared

WORD = r"[^\x20\x09-\x0D]+"


def shingles(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))}


def expected(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if one and sets[j] and 100 * both >= 80 * (len(one) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[root(i)] = min(key, ids.get(root(i), key))
    out = []
    for i, (key, _) in enumerate(rows):
        least = ids.get(root(i)) if sets[i] else key
        out.append((key, len(sets[i]), least, key == least))
    return sorted(out, key=repr)


def corpus(seed):
    """Families of edited copies, short and long, that share a passage with much else."""
    maker = random.Random(seed)
    words = [f"w{i}" for i in range(3000)] + ["É", "İ", "ß", "Ab"]
    passage = maker.choices(words, k=40)
    out = ["", None, " \t\n", "a", "A", "a b", "A  b", "x" * 5000, "a b c d", "a b c D e"]
    for size, members, edits in ((30, 20, 3), (120, 40, 12), (700, 24, 60), (60, 3, 1)):
        base = maker.choices(words, k=size)
        for _ in range(members):
            text = list(base)
            for _ in range(maker.randint(0, edits)):
                at = maker.randrange(len(text))
                text[at : at + maker.randint(0, 2)] = maker.choices(words, k=maker.randint(0, 2))
            out.append(maker.choice([" ", "\n", "  "]).join(text))
    for _ in range(80):
        text = maker.choices(words, k=maker.choice([10, 60, 150]))
        out.append(" ".join(text[:5] + passage + text[5:]))
    for _ in range(40):
        out.append(" ".join(maker.choices(words, k=maker.randint(1, 80))))
    out += out[20:40]
    maker.shuffle(out)
    return out


@pytest.mark.parametrize(("retained", "indexed", "block"), [(512, 32, 256), (64, 16, 12)])
def test_near_groups(documents, monkeypatch, retained, indexed, block):
    monkeypatch.setattr(minhash, "RETAINED", retained)
    monkeypatch.setattr(minhash, "INDEXED", indexed)
    monkeypatch.setattr(minhash, "MOST_BLOCK", block)
    monkeypatch.setattr(minhash, "HUBS", block // 4)
    monkeypatch.setattr(shared, "HOT_ROWS", 30 if block < 100 else 20_000)
    rows = list(enumerate(corpus(block)))
    rows += [(None, rows[30][1]), (None, "nobody knows this text"), (3, "a b c d"), (-4, None)]
    frame = documents([t for _, t in rows], [k for k, _ in rows])
    got = [tuple(r) for r in minhash.near_groups(frame).collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_nothing(documents):
    assert minhash.near_groups(documents([])).collect() == []
    got = minhash.near_groups(documents([None, "", "one two"], [4, 4, 9])).collect()
    assert sorted(tuple(r) for r in got) == [(4, 0, 4, True), (4, 0, 4, True), (9, 1, 9, True)]


def test_numbers_told_of_a_union():
    maker = np.random.default_rng(2)
    for _ in range(60):
        common = maker.integers(0, 2**63, 900).astype(np.uint64)
        sets = [
            np.unique(np.concatenate([common[:c], maker.integers(0, 2**63, e).astype(np.uint64)]))
            for c, e in ((900, 100), (880, 130), (300, 10), (280, 0), (500, 40))
        ]
        sketches, sizes = [s[:512] for s in sets], np.array([len(s) for s in sets])
        overlap = minhash._overlaps(np.concatenate(sketches), np.array([len(s) for s in sketches]))
        union = minhash._in_union(sketches, sizes, overlap)
        for i, one in enumerate(sets):
            for j, two in enumerate(sets):
                if i == j:
                    continue
                reach = min(
                    sketches[k][-1] if len(sketches[k]) < len(sets[k]) else np.uint64(2**64 - 1)
                    for k in (i, j)
                )
                both = np.intersect1d(one, two)
                assert overlap[i, j] == (both <= reach).sum()
                assert union[i, j] == (np.union1d(one, two) <= reach).sum()
        assert overlap[0, 1] >= minhash.least_shared(int(union[0, 1]))


def test_least_shared():
    least = minhash.least_shared(512)
    assert 340 < least < 370
    assert minhash.least_shared(1) == 0 and minhash.least_shared(1024) > 2 * least


def test_proposals_that_are_refused_make_way_for_others():
    base = np.arange(1000, 1600, dtype=np.uint64)
    sketches = [np.sort(np.concatenate([base, [np.uint64(i)]]))[:512] for i in (1, 2, 3)]
    sizes = np.array([601, 601, 601])
    least = minhash.shares_of_unions(1024)
    names, roles = [b"a", b"b", b"c"], np.full(3, -1)
    one = minhash.proposals(sketches, sizes, names, np.arange(3), roles, set(), 1, least)
    assert len(one) == 2 and not any(c for _, _, c in one)
    refused = {(names[i], names[j]) for i, j, _ in one}
    two = minhash.proposals(sketches, sizes, names, np.arange(3), roles, refused, 4, least)
    assert len(two) == 1 and (names[two[0][0]], names[two[0][1]]) not in refused


def test_blocks_of_long_lists_meet(spark, monkeypatch):
    """Every two members in different components share a block in the second step."""
    monkeypatch.setattr(minhash, "MOST_BLOCK", 8)
    rows = [(1, 40, bytes([i]), bytes([i if i < 15 else 99]), 0) for i in range(40)]
    members = spark.createDataFrame(rows, "v long, size long, node binary, comp binary, own int")
    blocks = minhash._beside_largest(members).collect()
    met = set()
    for block in {r.block for r in blocks}:
        own = [r for r in blocks if r.block == block]
        met |= {
            frozenset((a.node, b.node)) for a in own for b in own if a.role == 0 and b.role == 1
        }
    for i in range(40):
        for j in range(i):
            if j < 15:
                assert frozenset((bytes([i]), bytes([j]))) in met
    hubs = minhash._around_hubs(members.where(F.col("size") > 8))
    assert hubs.select("node").distinct().count() == 40


def test_lists_of_a_family_are_one(spark, monkeypatch):
    """Lists that share most members are merged; no two members of a list part, and lists
    that share one member only stay apart."""
    monkeypatch.setattr(minhash, "MOST_BLOCK", 8)
    family = [(v, i, v) for v in range(60) for i in range(40) if (i + v) % 8]
    others = [(100 + v, i, 1) for v in range(20) for i in (1000, 2000 + 8 * v, 2001 + 8 * v)]
    lists = {}
    for v, i, _ in family + others:
        lists.setdefault(v, set()).add(i.to_bytes(2, "big"))
    rows = [
        (v, len(lists[v]), i.to_bytes(2, "big"), own) for v, i, own in family + others
    ]
    members = spark.createDataFrame(rows, "v long, size long, node binary, own int")
    for salt in range(minhash.MERGES):
        members = shared.stored(minhash._merged(members, salt), "members")
    merged = {}
    for row in members.collect():
        assert bytes(row.node) not in merged.setdefault((row.v, row.size), set())
        merged[row.v, row.size].add(bytes(row.node))
    assert all(size == len(found) for (_, size), found in merged.items())
    assert all(any(own <= found for found in merged.values()) for own in lists.values())
    assert members.count() < len(family) // 5 + len(others)
    assert max(len(found) for found in merged.values()) <= 70


def crowd(maker, members, shared, own, words):
    """Texts that share a passage of most of their words, and else nothing."""
    passage = maker.choices(words, k=shared)
    return [" ".join(passage + maker.choices(words, k=own)) for _ in range(members)]


def test_only_crowds_that_are_no_family_are_listed_by_all_numbers(documents, monkeypatch):
    """Near copies meet in their crowded lists. Texts that share a passage of nearly half
    their words are listed again by all numbers."""
    monkeypatch.setattr(minhash, "INDEXED", 16)
    monkeypatch.setattr(minhash, "MOST_BLOCK", 24)
    monkeypatch.setattr(minhash, "HUBS", 6)
    counts = {}

    def counted(df, label):
        out = shared.stored(df, label)
        counts.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(minhash, "stored", counted)
    maker = random.Random(5)
    words = [f"w{i}" for i in range(20000)]
    family = crowd(maker, 60, 190, 5, words)
    apart = crowd(maker, 60, 90, 110, words)
    rows = list(enumerate(family + apart))
    frame = documents([t for _, t in rows], [k for k, _ in rows])
    got = [tuple(r) for r in minhash.near_groups(frame).collect()]
    assert sorted(got, key=repr) == expected(rows)
    assert 0 < counts["listed-again"][0] <= len(apart)
    assert counts["all-numbers"][0] <= len(apart) * 197
