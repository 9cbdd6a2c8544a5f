"""Ranked search against scores worked out term by term."""

import math
import random
import re
from collections import Counter

import pytest

from ebbtide.llm import search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, top):
    held = [(key, Counter(terms(text))) for key, text in docs]
    held = [(key, counts, counts.total()) for key, counts in held if counts]
    count, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, counts, _ in held for t in counts)
    out = []
    for item, text in items:
        scores = []
        for key, counts, n in held:
            m = 75 + (25 * n * count) // length
            score = 0
            for t in terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scores.append((-score, key is None, key))
        for rank, (score, _, key) in enumerate(sorted(scores, key=repr_order)[:top], 1):
            out.append((item, rank, key, -score))
    return out


def repr_order(entry):
    score, nameless, key = entry
    return (score, nameless, 0 if key is None else key)


def corpus(seed, count):
    maker = random.Random(seed)
    common = ["the", "of", "AND", "Ünd", "und"]
    rare = [f"w{i}" for i in range(300)] + ["é日本", "x_y", "a-b", "İ", "ß"]
    out = []
    for _ in range(count):
        size = maker.choice([0, 1, 3, 20, 60, 400])
        out.append(maker.choice([" ", ", ", "\n"]).join(
            maker.choice(common) if maker.random() < 0.6 else maker.choice(rare[: maker.randint(1, 305)])
            for _ in range(size)
        ))
    return out


@pytest.mark.parametrize("small", [True, False])
def test_search(spark, documents, monkeypatch, small):
    if small:
        for name, value in (("SHARD_ROWS", 50), ("SHARD_POSTINGS", 300), ("WINDOW", 8)):
            monkeypatch.setattr(search, name, value)
        monkeypatch.setattr(search, "SHORT_SHARE", 1 / 8)
        monkeypatch.setattr(search, "BLOCK_ITEMS", 4)
        monkeypatch.setattr(search, "_LONG_TEXT", 100)
    texts = corpus(1, 260)
    # Ties, repeated rows, null ids, null and empty texts, one long text.
    texts += [texts[5]] * 30 + [None, "", " .,- ", "the " * 30_000 + "w7", "w7", "w7"]
    ids = [*range(len(texts) - 4), None, 2, 3, None]
    frame = documents(texts, ids).repartition(3)
    asked = [t for t in corpus(2, 14) if t] + ["", None, "unseen words", "w7", "w7", "THE the Of", "w7 w7 é日本"]
    rows = [(i, t, b"x", 3) for i, t in enumerate(asked)] + [(0, asked[1], b"", 1), (None, "w9", b"", 1)]
    items = spark.createDataFrame(rows, "item_id long, text string, id binary, rank int")
    got = [tuple(r) for r in search.search(frame, items, top=20).collect()]
    want = expected(list(zip(ids, texts, strict=True)), [r[:2] for r in rows], 20)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(got) > 200


def test_search_of_nothing(spark, documents):
    items = spark.createDataFrame([(1, "a"), (2, None)], "item_id long, text string")
    assert search.search(documents([]), items).collect() == []
    assert search.search(documents(["a", None]), items.where("false")).collect() == []
    assert search.search(documents([None, ". "]), items).collect() == []


def test_places():
    best = search.Best(2)
    assert best.least() == 1
    import numpy as np

    best.offer(np.array([5, 5, 4]), np.array([9, 3, 1]), np.array([False, False, False]))
    assert best.ids.tolist() == [3, 9] and best.least() == 5
    best.offer(np.array([5, 5]), np.array([4, 0]), np.array([False, True]))
    assert best.ids.tolist() == [3, 4]
