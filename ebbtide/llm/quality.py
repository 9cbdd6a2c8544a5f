"""Quality rules: counted properties, and a classifier trained on labelled rows.

The classifier is logistic regression over hashed word n-grams and character n-grams.
A text's features are square roots of their shares among its n-grams, so its length
does not matter. Probabilities are calibrated on rows held out from training, and
documents are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import WHITE, known, ship, word_numbers

_BITS = 13
BUCKETS = 1 << _BITS
# Labelled rows of either class that the classifier is fitted on, at most.
TRAINING_ROWS = 700
# A document that passes the counted rules is kept from this probability of good
# quality on.
LEAST_PROBABILITY = 0.2
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_MIX = {2: np.uint16(40503), 4: np.uint32(2654435769), 8: np.uint64(0x9E3779B97F4A7C15)}


def _shares(grams: np.ndarray) -> np.ndarray:
    """Buckets of a text's n-grams, given as numbers, and the root of their shares."""
    mixed = grams * _MIX[grams.dtype.itemsize]
    buckets = mixed >> grams.dtype.type(8 * grams.dtype.itemsize - _BITS)
    return np.sqrt(np.bincount(buckets.astype(np.intp), minlength=BUCKETS) / len(grams))


def examined(text: str) -> tuple[tuple[int, int, int, int, int], np.ndarray]:
    """Words, code points in words, symbols, repeated lines and words in 3-word windows
    that occur more than once; and the feature vector: n-gram shares of each kind,
    under a square root."""
    data = b" " + text.encode() + b" "
    raw = np.frombuffer(data, np.uint8)
    words = word_numbers(raw)
    windows = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:]
    ordered = np.sort(windows)
    repeated = _repeated(text.encode().split()) if (ordered[1:] == ordered[:-1]).any() else 0
    white = sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    found = (len(words), len(text) - white, symbols, len(lines) - len(set(lines)), repeated)
    vector = np.zeros(BUCKETS)
    for kind in ("<u2", "<u4"):
        count = len(data) - int(kind[2]) + 1
        if count > 0:
            vector += _shares(np.ndarray(count, kind, data, 0, (1,)))
    if len(words):
        vector += _shares(words + np.uint64(101))
    if len(words) > 1:
        vector += _shares(words[:-1] * np.uint64(31) + words[1:])
    return found, vector.astype(np.float32)


def _repeated(words: list[bytes]) -> int:
    """Words in 3-word windows found more than once. The numbers of two windows may
    meet, so the windows themselves are compared."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    repeated = end = 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            repeated += i + 3 - max(i, end)
            end = i + 3
    return repeated


def _sample(labels: DataFrame, key: str, label: str) -> DataFrame:
    """At most ``TRAINING_ROWS`` labelled ids of either class, and what each stands for."""
    once = (
        labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    sizes = {row.y: row.n for row in once.groupBy("y").agg(F.count("*").alias("n")).collect()}
    parts = [
        once.where(F.col("y") == y)
        .orderBy(F.xxhash64("id"), "id")
        .limit(TRAINING_ROWS)
        .withColumn("weight", F.lit(n / min(n, TRAINING_ROWS)))
        for y, n in sorted(sizes.items())
    ]
    return parts[0].union(parts[1]) if len(parts) == 2 else None


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> tuple[np.ndarray, float]:
    """Weights and offset of the calibrated classifier.

    Without labelled rows of both classes, nothing is learned and every text is good.
    """
    chosen = _sample(labels, key, label)
    if chosen is None:
        return np.zeros(BUCKETS, np.float32), 50.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [examined(t)[1] for t in batch.column(0).to_pylist()]
            places = [np.flatnonzero(v) for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    batch.column(3),
                    pa.array([p.astype(np.uint16).tobytes() for p in places], pa.binary()),
                    pa.array(
                        [v[p].tobytes() for v, p in zip(vectors, places, strict=True)],
                        pa.binary(),
                    ),
                ],
                ["id", "y", "weight", "places", "amounts"],
            )

    rows = (
        docs.select(F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text"))
        .join(F.broadcast(chosen), "id")
        .select("text", "id", "y", "weight")
        .mapInArrow(run, "id long, y int, weight double, places binary, amounts binary")
        .collect()
    )
    rows = sorted(rows, key=lambda r: (r.id, r.places, r.amounts))
    if len({row.y for row in rows}) < 2:
        return np.zeros(BUCKETS, np.float32), 50.0
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, row in enumerate(rows):
        x[i, np.frombuffer(row.places, np.uint16)] = np.frombuffer(row.amounts, np.float32)
    return fit(
        x, np.array([row.y for row in rows], float), np.array([row.weight for row in rows])
    )


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by Newton steps on the matrix of inner
    products, three rows in four; the fourth calibrates scale and offset."""
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    ours = weight / weight.mean()
    inner = (x[~held] @ x[~held].T).astype(float) + 1
    a = _newton(inner, y[~held], ours[~held], 0.05)
    w, offset = x[~held].T @ a.astype(np.float32), a.sum()
    tune = held if held.any() else ~held
    scores = x[tune] @ w + offset
    scale, shift = _line(scores, y[tune], ours[tune])
    return (w * scale).astype(np.float32), float(offset * scale + shift)


def _newton(inner: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    a = np.zeros(len(y))
    for _ in range(12):
        score = np.clip(inner @ a, -30, 30)
        p = 1 / (1 + np.exp(-score))
        curve = np.maximum(weight * p * (1 - p), 1e-6)
        target = score + weight * (y - p) / curve
        new = np.linalg.solve(inner + np.diag(ridge / curve), target)
        done = np.abs(inner @ (new - a)).max() < 1e-3
        a = 0.5 * a + 0.5 * new if not done else new
        if done:
            break
    return a


def _line(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make a score a log-odds on rows it was not fitted on."""
    scale, shift = 1.0, 0.0
    design = np.stack([score, np.ones(len(score))], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(scale * score + shift, -30, 30)))
        slope = design.T @ (weight * (p - y)) + 1e-2 * np.array([scale - 1, shift])
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        scale, shift = np.array([scale, shift]) - 0.7 * np.linalg.solve(curve, slope)
    return max(scale, 1e-3), shift


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    least: float = LEAST_PROBABILITY,
) -> DataFrame:
    """``id``, the counted properties, ``base_failed``, ``probability`` and ``kept`` of
    every row of ``docs``.

    Null texts count as empty; texts without words fail the counted rules. Rows that
    repeat are each judged; an empty table gives no rows; labels of unknown documents,
    null labels and other columns are not used. Of an id labelled twice the better
    label counts.
    """
    model = train(docs, labels, key, text, label)
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, offset = broadcast.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not texts:
                continue
            rows = [(f, v @ weights) for f, v in map(examined, texts)]
            found = np.array([f for f, _ in rows], np.int64)
            score = np.array([s for _, s in rows], float) + offset
            chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
            words, repeated = found[:, 0], found[:, 4]
            failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(found[:, i]) for i in range(len(names))),
                    pa.array(failed),
                    pa.array(chance),
                    pa.array(~failed & (chance >= least)),
                ],
                ["id", *names, "base_failed", "probability", "kept"],
            )

    columns = ", ".join(f"{name} long" for name in ("id", *names))
    return docs.select(
        F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text")
    ).mapInArrow(run, f"{columns}, base_failed boolean, probability double, kept boolean")


ship(__name__)
