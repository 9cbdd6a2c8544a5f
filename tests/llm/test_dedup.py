"""Exact, near and passage duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ebbtide.llm import exact, fmindex, graph, simhash, substrings

WORD = r"[^\x20\x09-\x0D]+"


def texts(seed, count=60):
    maker = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "İ", "ß", "Ab", "Ⅷ", " x"]
    passages = [" ".join(maker.choices(words, k=maker.randint(8, 30))) for _ in range(6)]
    out = ["", None, " \t\n", "a", "A b", "a  b", "ab", "x" * 5000]
    for _ in range(count):
        parts = maker.choices(passages, k=maker.randint(0, 3)) + maker.choices(words, k=5)
        maker.shuffle(parts)
        out.append(maker.choice([" ", "\n", "  "]).join(parts))
    return out + out[10:20]


def expected_exact(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((key, text or ""))
    out = []
    for norm, members in groups.items():
        order = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        keep, left = order[0][0], True
        for key, _ in order:
            out.append((key, keep, len(members), left, hashlib.sha256(norm.encode()).hexdigest()))
            left = False if key == keep else left
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(documents, weak):
    rows = list(enumerate(texts(3)))
    rows += [(None, "null id"), (None, "null id"), (5, "a  b"), (-3, "ab"), (2**62, "ab ")]
    frame = documents([t for _, t in rows], [k for k, _ in rows])
    digest = (lambda sha: F.substring(sha, 1, 1).substr(1, 1)) if weak else (lambda sha: sha)
    found = exact.exact_groups(frame, digest=digest).withColumn("sha", F.lower(F.hex("sha")))
    got = [(r.id, r.keep_id, r.group_size, r.kept, r.sha) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected_exact(rows), key=repr)
    if not weak:
        kept = sorted((k for k, _, _, left, _ in got if left), key=repr)
        whole = exact.without_copies(frame)
        assert whole.columns == frame.columns
        assert sorted((r.doc_id for r in whole.collect()), key=repr) == kept


def expected_near(rows):
    prints = {}
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(WORD, lowered)
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles] if words else []
        prints[key] = sum(
            1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
        )
    keys, least = sorted(prints), {k: k for k in prints}
    for _ in keys:
        for a in keys:
            for b in keys:
                if bin(prints[a] ^ prints[b]).count("1") <= 3:
                    least[a] = min(least[a], least[b])
    return {k: (prints[k], least[k]) for k in keys}


def test_near_groups(documents):
    rows = list(enumerate(texts(4, 40)))
    frame = documents([t for _, t in rows])
    got = {r.id: (r.fp % 2**64, r.component_id) for r in simhash.near_groups(frame).collect()}
    assert got == expected_near(rows)
    kept = simhash.one_of_each_group(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in got.values()}


def test_one_of_each_group_without_ids_and_with_repeated_ids(documents):
    one, two, three = ("a b c " * 30, "d e f g " * 30, "h i j k l " * 30)
    rows = [(4, one), (None, one), (None, two), (None, two), (7, one), (7, three), (7, three)]
    frame = documents([t for _, t in rows], [k for k, _ in rows])
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each_group(frame).collect()]
    assert sorted(kept, key=repr) == [(4, one), (7, three), (7, three), (None, two)]


@pytest.mark.parametrize("texts", [["ab", "a  b"], ["a  b", "ab"]])
@pytest.mark.parametrize("key", [None, 1])
def test_longest_original_stays(documents, texts, key):
    frame = documents([*texts, "c"], [key, key, 2]).coalesce(1)
    left = {r.text for r in exact.without_copies(frame).collect()}
    assert left == {"a  b", "c"}


def test_links_of_dense_and_sparse_fingerprints(spark):
    maker = random.Random(8)
    values = {0, -1}
    for _ in range(30):
        center = maker.getrandbits(64)
        for _ in range(12):
            value = center
            for bit in maker.sample(range(64), maker.randint(0, 5)):
                value ^= 1 << bit
            values.add(value - (value >> 63 << 64))
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.links(frame)).collect()}
    bits = np.array(values, np.int64).view(np.uint64)
    least = list(range(len(values)))
    for _ in range(12):
        for i in range(len(values)):
            near = np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 3)
            least[i] = min(least[j] for j in near)
    assert {v: roots.get(v, v) for v in values} == {
        v: values[j] for v, j in zip(values, least, strict=True)
    }


def test_links_of_a_large_family(spark, monkeypatch):
    """Many distinct fingerprints share fields; no task may see them all as one block."""
    maker = random.Random(9)
    center, places = maker.getrandbits(64), maker.sample(range(64), 15)
    values = set()
    while len(values) < 900:
        value = center
        for bit in maker.sample(places, maker.randint(0, 15)):
            value ^= 1 << bit
        values.add(value - (value >> 63 << 64))
    values = sorted(values)
    whole = simhash.block_links

    def bounded(found, distance=3):
        assert len(found) <= 16
        return whole(found, distance)

    monkeypatch.setattr(simhash, "MOST_BLOCK", 16, raising=False)
    monkeypatch.setattr(simhash, "block_links", bounded)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.links(frame)).collect()}
    bits = np.array(values, np.int64).view(np.uint64)
    least = np.arange(len(values))
    near = np.bitwise_count(bits[:, None] ^ bits) <= 3
    for _ in range(40):
        least = np.where(near, least, len(values)).min(1)
    assert {v: roots.get(v, v) for v in values} == {
        v: values[j] for v, j in zip(values, least, strict=True)
    }


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in graph.components(links).collect()}
    assert roots == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def expected_passages(rows, window):
    starts = {}
    for key, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            place = tuple(words[i : i + window])
            starts[place] = min(key, starts.get(place, key))
    out = []
    for key, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if starts[tuple(words[i : i + window])] < key:
                gone[i : i + window] = [True] * window
        left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((key, len(words), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window,meeting", [(12, 8000), (12, 0), (3, 8000)])
def test_repeated_passages(documents, monkeypatch, window, meeting):
    monkeypatch.setattr(substrings, "MEETING", meeting)
    rows = list(enumerate(texts(6)))
    rows += [(3, "same id " * 20), (3, "same id " * 20), (3, "same id " * 21)]
    frame = documents([t for _, t in rows], [k for k, _ in rows])
    found = substrings.repeated_passages(frame, window=window)
    got = [(r.id, r.n_words, r.n_removed, r.kept_sha.hex()) for r in found.collect()]
    assert sorted(got) == expected_passages(rows, window)


def test_passages_beside_line_ends_that_are_words(documents):
    body = " ".join(f"w{i}" for i in range(30))
    ends = ["", " \u2028", " \x85", "\u2029 ", " \r\n", "\n\n", " \u2028\r\n"]
    rows = list(enumerate(body + end for end in ends)) + [(9, "\u2028 " + body)]
    found = substrings.repeated_passages(documents([t for _, t in rows], [k for k, _ in rows]), window=12)
    got = [(r.id, r.n_words, r.n_removed, r.kept_sha.hex()) for r in found.collect()]
    assert sorted(got) == expected_passages(rows, 12)


@pytest.mark.parametrize("length", [1, 2, 5, 16])
def test_index_finds_every_window(length):
    maker = np.random.default_rng(length)
    parts = [maker.integers(1, 4, maker.integers(1, 60)) for _ in range(20)]
    owners = maker.integers(0, 99, len(parts))
    best = {}
    for part, owner in zip(parts, owners, strict=True):
        for i in range(len(part) - length + 1):
            place = tuple(part[i : i + length])
            best[place] = min(owner, best.get(place, owner))
    text = np.concatenate([np.concatenate([[0], part]) for part in parts])
    sizes = np.array([len(part) for part in parts])
    starts = np.cumsum(sizes + 1) - sizes
    index = fmindex.Index(text, np.repeat(owners, sizes + 1), length)
    got = index.least_owners(text, starts, sizes)
    for part, start in zip(parts, starts, strict=True):
        for i in range(len(part) - length + 1):
            assert got[start + i] == best[tuple(part[i : i + length])]


def test_empty_tables(documents):
    empty = documents([])
    assert exact.exact_groups(empty).count() == 0
    assert exact.without_copies(empty).count() == 0
    assert simhash.near_groups(empty).count() == 0
    assert simhash.one_of_each_group(empty).count() == 0
    assert substrings.repeated_passages(empty).count() == 0


def test_null_ids(documents):
    frame = documents(["a b c " * 30, "a b c " * 30, "x"], [None, 4, None])
    near = sorted((str(r.id), str(r.component_id)) for r in simhash.near_groups(frame).collect())
    assert near == [("4", "4"), ("None", "4"), ("None", "None")]
    found = substrings.repeated_passages(frame, window=10).collect()
    assert sorted((str(r.id), r.n_removed) for r in found) == [("4", 0), ("None", 0), ("None", 90)]
