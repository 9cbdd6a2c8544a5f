"""Language identification by a convolutional network over bytes.

Filters of several widths slide over embedded bytes; the greatest response of each
filter in a window of fixed length goes to a softmax layer. The network is trained in
numpy on labelled windows and applied to all windows of every text in large batches.
One more class, of made-up text that is like no language, is learned beside them; its
share tells how much of a text is in any of the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, ship, slices

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 14
EMBEDDING = 6
# Labelled documents per language that windows are learned from, about.
TRAINING_ROWS = 700
EPOCHS = 8
UNKNOWN = "und"
# Documents of which the languages have a smaller share are rejected by the pipeline.
LEAST_SHARE = 0.1
_BATCH_WINDOWS = 512


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # byte, dimension
    filters: np.ndarray  # width x dimension, filter
    bias: np.ndarray  # filter
    output: np.ndarray  # filter, language; the last column is for none of them
    output_bias: np.ndarray  # language

    def parts(self) -> tuple:
        """What a worker needs to put the network together; plain values only, as the
        workers need no copy of this library."""
        return tuple(vars(self).values())


def windows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts in lower case, cut one after the other and padded with
    zeros; the text each belongs to; its bytes."""
    data = [text.lower().encode() for text in texts]
    counts = np.array([-(-len(d) // WINDOW) for d in data], np.int64)
    padded = b"".join(d.ljust(int(c) * WINDOW, b"\0") for d, c in zip(data, counts, strict=True))
    windows = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    sizes = np.array([len(d) for d in data], np.int64)
    place = np.arange(len(owner)) - first[owner]
    return windows, owner, np.minimum(sizes[owner] - place * WINDOW, WINDOW)


def _patches(network: Network, windows: np.ndarray) -> np.ndarray:
    """The embedded bytes under the widest filter, for every place of every window."""
    widest = max(WIDTHS)
    padded = np.pad(windows, ((0, 0), (0, widest - 1)))
    embedded = network.embedding[padded].reshape(len(windows), -1)
    shape = (len(windows), WINDOW, widest * EMBEDDING)
    strides = (embedded.strides[0], EMBEDDING * embedded.itemsize, embedded.itemsize)
    view = np.lib.stride_tricks.as_strided(embedded, shape, strides)
    return np.ascontiguousarray(view).reshape(-1, shape[2])


def _responses(network: Network, patches: np.ndarray) -> np.ndarray:
    return (patches @ network.filters).reshape(-1, WINDOW, network.filters.shape[1])


def probabilities(network: Network, windows: np.ndarray) -> np.ndarray:
    """The network's softmax for each window."""
    out = np.zeros((len(windows), len(network.output_bias)), np.float32)
    for first in range(0, len(windows), _BATCH_WINDOWS):
        part = windows[first : first + _BATCH_WINDOWS]
        pooled = _responses(network, _patches(network, part)).max(1) + network.bias
        out[first : first + len(part)] = _softmax(
            np.maximum(pooled, 0) @ network.output + network.output_bias
        )
    return out


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def _width_mask() -> np.ndarray:
    """Which inputs each filter sees: narrow ones the first bytes only."""
    mask = np.zeros((max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def like_none(texts: list[str], rng: np.random.Generator) -> list[str]:
    """Made-up texts that are like no language: characters of the texts in random order,
    random keys and consonants, few characters over and over, tags and numbers, and
    characters of any script."""
    keys = list("qwertyuiopasdfghjklzxcvbnm1234567890;,./ ")
    consonants = list("bcdfghjklmnpqrstvwxz ")
    scraps = ["<br/>", "</div>", "<a href=", "&nbsp;", "0x", "{", "};", "id=", "==", "#", "_", "|"]
    out = []
    for i, text in enumerate(texts):
        size = int(rng.integers(20, WINDOW))
        kind = i % 6
        if kind == 0:
            made = "".join(rng.permutation(list(text)))
        elif kind == 1:
            made = "".join(rng.choice(keys, size))
        elif kind == 2:
            made = "".join(rng.choice(consonants, size))
        elif kind == 3:
            few = [chr(c) for c in rng.integers(33, 127, int(rng.integers(1, 4)))]
            made = "".join(rng.choice(few, size))
        elif kind == 4:
            parts = [str(n) for n in rng.integers(0, 10**6, 12)] + scraps
            made = "".join(rng.choice(parts, size // 4))
        else:
            low = int(rng.choice([0x370, 0x400, 0x590, 0x900, 0xE00, 0x3040, 0x4E00, 0xAC00]))
            made = "".join(map(chr, rng.integers(low, low + 200, size // 2)))
        out.append(made)
    return out


def fit(texts: list[str], languages: list[str], seed: int = 7) -> Network:
    """A network trained with Adam on windows of the texts, languages weighted alike, and
    like them as many made-up texts as there are for a language.

    Each epoch cuts some windows short, so that short texts are met as well.
    """
    names = sorted(set(languages))
    index = {name: i for i, name in enumerate(names)}
    rng = np.random.default_rng(seed)
    made = like_none(list(rng.permutation(texts)[: -(-len(texts) // len(names))]), rng)
    classes = len(names) + 1
    windows, owner, sizes = windows_of([*texts, *made])
    target = [index[name] for name in languages] + [len(names)] * len(made)
    target = np.array(target, np.int64)[owner]
    share = np.bincount(target, minlength=classes) / max(1, len(target))
    weight = 1 / (classes * np.maximum(share, 1e-9))
    mask = _width_mask()
    network = Network(
        names,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(mask.shape[1], np.float32),
        rng.normal(0, 0.2, (mask.shape[1], classes)).astype(np.float32),
        np.zeros(classes, np.float32),
    )
    fields = ("embedding", "filters", "bias", "output", "output_bias")
    moments = {f: [np.zeros_like(getattr(network, f)) for _ in range(2)] for f in fields}
    step, size = 0, 64
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for first in range(0, len(order), size):
            chosen = order[first : first + size]
            batch = windows[chosen].copy()
            cut = np.where(rng.random(len(chosen)) < 0.3, rng.integers(6, WINDOW, len(chosen)), WINDOW)
            batch[np.arange(WINDOW) >= cut[:, None]] = 0
            slopes = _slopes(network, batch, target[chosen], weight[target[chosen]], mask)
            step += 1
            for field, slope in zip(fields, slopes, strict=True):
                one, two = moments[field]
                one += 0.1 * (slope - one)
                two += 0.001 * (slope * slope - two)
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                getattr(network, field)[...] -= rate * one / (np.sqrt(two) + 1e-8)
    return network


def _slopes(
    network: Network, batch: np.ndarray, target: np.ndarray, weight: np.ndarray, mask: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Gradients of the weighted log loss; only the places of the greatest responses
    pass any on."""
    patches = _patches(network, batch)
    responses = _responses(network, patches)
    place = responses.argmax(1)
    pooled = np.take_along_axis(responses, place[:, None], 1)[:, 0] + network.bias
    hidden = np.maximum(pooled, 0)
    error = _softmax(hidden @ network.output + network.output_bias)
    error[np.arange(len(batch)), target] -= 1
    error *= (weight / len(batch))[:, None]
    back = (error @ network.output.T) * (pooled > 0)
    rows = np.arange(len(batch))[:, None] * WINDOW + place
    seen = patches[rows]  # window, filter, input
    filters = np.einsum("wf,wfi->if", back, seen) * mask
    inputs = back[:, :, None] * network.filters.T[None]
    padded = np.pad(batch, ((0, 0), (0, max(WIDTHS) - 1)))
    spots = place[:, :, None] + np.arange(max(WIDTHS))
    bytes_seen = padded[np.arange(len(batch))[:, None, None], spots].ravel()
    parts = inputs.reshape(-1, EMBEDDING)
    embedding = np.stack(
        [np.bincount(bytes_seen, parts[:, i], 256) for i in range(EMBEDDING)], 1
    )
    return embedding.astype(np.float32), filters, back.sum(0), hidden.T @ error, error.sum(0)


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAINING_ROWS
) -> Network | None:
    """The network learned from a bounded sample of the labelled ``docs``.

    Every language gives about ``rows`` documents, picked by a hash of their id, and of
    each one window's worth of text at a place that a hash decides.
    """
    labelled = docs.select(
        F.col(key).cast("string").alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not sizes:
        return None
    rate = F.create_map(*[F.lit(x) for row in sizes for x in (row.lang, min(1.0, rows / row.n))])
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    room = F.greatest(F.length("text") - F.lit(WINDOW), F.lit(0)) + 1
    place = F.pmod(F.xxhash64("id", F.lit(1)), room.cast("long")) + 1
    picked = (
        labelled.where(chance < rate[F.col("lang")])
        .where(F.col("text").rlike(r"\p{L}"))
        .select("lang", F.substr("text", place.cast("int"), F.lit(WINDOW)).alias("text"), "id")
        .orderBy(F.xxhash64("id"), "id", "text")
        .limit(2 * rows * len(sizes))
        .collect()
    )
    found = sorted((row.lang, row.text) for row in picked)
    if not found:
        return None
    return fit([t for _, t in found], [name for name, _ in found])


def judged(
    network: Network | None, texts: list[str], lettered: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The language of each text, its score, and the share of all languages; ``lettered``
    tells which have letters."""
    names = np.array([UNKNOWN] * len(texts), object)
    scores, shares = np.zeros(len(texts)), np.zeros(len(texts))
    asked = np.flatnonzero(lettered)
    for part in slices([texts[i] for i in asked]) if network is not None else ():
        own = asked[part]
        windows, owner, sizes = windows_of([texts[i] for i in own])
        found = probabilities(network, windows)[:, :-1] * sizes[:, None]
        total = np.stack([np.bincount(owner, share, len(own)) for share in found.T], 1)
        total /= np.bincount(owner, sizes, len(own))[:, None]
        names[own] = np.array(network.languages, object)[total.argmax(1)]
        scores[own] = np.clip(total.max(1), 0, 1)
        shares[own] = np.clip(total.sum(1), 0, 1)
    return names, scores, shares


def _lettered(text: str) -> Column:
    return known(F.col(text)).rlike(r"\p{L}")


def identify(
    docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` of every row of ``docs``.

    The score of a language is its probability averaged over all windows of the text by
    their bytes, however long it is; ties go by name. Texts that are null or have no letter, and all texts
    where nothing could be learned, are ``und`` with score 0. Rows that repeat are each
    scored; an empty table gives no rows; other columns are not read.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(network and network.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = broadcast.value and Network(*broadcast.value)
        for batch in batches:
            lettered = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            names, scores, _ = judged(network, batch.column(1).to_pylist(), lettered)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                ["id", "lang_pred", "score"],
            )

    return docs.select(
        F.col(key).cast("long").alias("id"),
        known(F.col(text)).alias("text"),
        _lettered(text).alias("lettered"),
    ).mapInArrow(run, "id long, lang_pred string, score double")


def confident(
    docs: DataFrame, network: Network | None, text: str = "text", least: float = LEAST_SHARE
) -> DataFrame:
    """The rows of ``docs`` that are in the languages by a share of ``least`` or more,
    with all their columns; texts of several of the languages stay. Texts that are null
    or have no letter go. Texts are read whole, however long; where nothing could be
    learned, texts with letters stay."""
    broadcast = docs.sparkSession.sparkContext.broadcast(network and network.parts())
    place, width = docs.columns.index(text), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = broadcast.value and Network(*broadcast.value)
        for batch in batches:
            kept = batch.column(width).to_numpy(zero_copy_only=False).astype(bool)
            if network is not None:
                texts = [t or "" for t in batch.column(place).to_pylist()]
                kept &= judged(network, texts, kept)[2] >= least
            yield batch.select(list(range(width))).filter(pa.array(kept))

    return docs.select("*", _lettered(text).alias("_lettered_text_")).mapInArrow(run, docs.schema)


ship(__name__)
