"""SentencePiece encoding and decoding, with one forward pass over shared prefixes.

A text is cut into marked words (a word with the space before it), which never merge
with each other. The distinct words of a batch, sorted, are the depth-first order of
their trie: each word keeps the forward states of the prefix it shares with the word
before it and goes on from there. The state of a prefix is the last piece of its best
segmentation; the path back over these pieces is the segmentation, as in a Viterbi
search. The model is one of merges: the best segmentation of a prefix is the one that
merging by score gives, and a piece can end it only if merging its text together with
the piece before gives these two pieces again. Exactly one piece does, so the result
equals the library's; the greatest sum of scores would not.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, ship, slices

# Fixed value: what stands for a space in pieces.
MARK = "▁"
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]")
# Words a worker's cache holds before it drops those not met just then, and pairs of
# pieces before they start anew.
CACHED = 250_000


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """The pieces of a model file of merges with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # How long the pieces are that end with some three characters, longest first.
        sizes: dict[str, set[int]] = {}
        for piece in self.ids:
            sizes.setdefault(piece[-3:], {1, 2}).add(len(piece))
        self.sizes = {end: tuple(sorted(s, reverse=True)) for end, s in sizes.items()}
        # Where no piece has two characters side by side, no merge crosses.
        pairs = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        alone = "".join(c for c in "\n\t\r" if not any(c in pair for pair in pairs))
        ends = "".join(
            re.escape(c)
            for c in map(chr, range(33, 127))
            if not c.isalnum() and not any(p[1] == c and _LETTERS.match(p[0]) for p in pairs)
        )
        other = f"{MARK}*[^{MARK}{alone}]+|{MARK}+"
        word = f"{MARK}*{_LETTERS.pattern}+(?=[{ends}{MARK}{alone}]|\\Z)|" if ends else ""
        self.words = re.compile(word + (f"[{alone}]|" if alone else "") + other)
        self.spelled = [self._spelled(i) for i in range(size)]
        self.fits: dict[tuple[str, str], bool] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, float]] | None] = {}

    def merges(self, text: str) -> Iterator[tuple[float, list[str]]]:
        """The steps of merging by score, the leftmost first among equals: the score
        that counts from a step on, and the parts before it."""
        parts, scores = list(text), self.scores
        while True:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            yield best, parts
            if at < 0:
                return
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]

    def edge(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """The parts that stand at one end of a piece (0 or -1) while it is merged, each
        with the score at which it is merged further; None if merging does not end with
        the piece."""
        found = self.edges.get((piece, side))
        if found is None and (piece, side) not in self.edges:
            steps = list(self.merges(piece))
            if len(steps[-1][1]) == 1:
                found = []
                for (score, parts), (_, after) in zip(steps, steps[1:], strict=False):
                    if parts[side] != after[side]:
                        found.append((parts[side], score))
                found.append((piece, -np.inf))
            self.edges[piece, side] = found
        return found

    def pair_fits(self, before: str, piece: str) -> bool:
        """Whether merging both texts together gives these two pieces: at no time may
        the parts that meet between them score better than what merges either next."""
        fits = self.fits.get((before, piece))
        if fits is not None:
            return fits
        right = self.edge(piece, 0)
        fits = right is not None
        if fits and before:
            left = self.edge(before, -1)
            i = j = 0
            while True:
                (one, leave_one), (two, leave_two) = left[i], right[j]
                across = self.scores.get(one + two)
                if across is not None and across > leave_one and across >= leave_two:
                    fits = False
                    break
                if leave_one == leave_two == -np.inf:
                    break
                if leave_one >= leave_two:
                    i += 1
                else:
                    j += 1
        if len(self.fits) > CACHED:
            self.fits.clear()
        self.fits[before, piece] = fits
        return fits

    def segment(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each of the sorted ``words`` with the ids of its pieces, four bytes each."""
        last: list[str] = [""]
        path: list[tuple[int, int]] = [(0, 0)]
        before = ""
        ids, sizes, fits, pair_fits = self.ids, self.sizes, self.fits, self.pair_fits
        for word in words:
            shared = 0
            for one, two in zip(before, word, strict=False):
                if one != two:
                    break
                shared += 1
            del last[shared + 1 :], path[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for size in sizes.get(word[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                    start = end - size
                    piece = word[start:end]
                    if start >= 0 and piece in ids:
                        ok = fits.get((last[start], piece))
                        if ok or (ok is None and pair_fits(last[start], piece)):
                            last.append(piece)
                            path.append((start, ids[piece]))
                            break
                else:
                    # A character without a piece: its bytes, which merge with nothing.
                    last.append(word[end - 1])
                    path.append((end - 1, -1))
            yield word, self._back(word, path)
            before = word

    def _back(self, word: str, path: list[tuple[int, int]]) -> bytes:
        out, end = [], len(word)
        while end:
            start, piece = path[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(self.bytes[b] for b in reversed(word[start:end].encode()))
            end = start
        return array("i", out[::-1]).tobytes()

    def _spelled(self, piece: int) -> bytes:
        name = self.pieces[piece]
        return bytes([self.bytes.index(piece)]) if piece in self.bytes else name.encode()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of pieces: bytes joined, marks as spaces, without the first one."""
        out = b"".join(map(self.spelled.__getitem__, ids))
        return out.decode("utf-8", "replace").replace(MARK, " ")[1:]


def encoder(vocabulary: Vocabulary) -> Callable[[list[str]], list[np.ndarray]]:
    """A function that encodes texts; words met before come from its cache."""
    cache: dict[str, bytes] = {}
    find = vocabulary.words.findall

    def encode(texts: list[str]) -> list[np.ndarray]:
        split = [find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        met = set().union(*split)
        new = met.difference(cache)
        if len(cache) + len(new) > CACHED:
            # Words met just now stay: most of the others occur once.
            again = {word: cache[word] for word in met.difference(new)}
            cache.clear()
            cache.update(again)
        cache.update(vocabulary.segment(sorted(new)))
        found = (b"".join(map(cache.__getitem__, words)) for words in split)
        return [np.frombuffer(ids, np.intc) for ids in found]

    return encode


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """``id``, ``pieces`` (ids) and ``intact`` (whether they decode to the text) of
    every row of ``docs``.

    Ids are those of the library for the model file at ``path``. A text decodes to
    itself, but for marks in it, which decode to spaces; that counts as intact. Null
    texts count as empty and have no pieces. Rows that repeat are each encoded; an empty
    table gives no rows; other columns are not read. Workers read ``path`` themselves.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        encode = encoder(vocabulary)
        for batch in batches:
            whole = batch.column(1).to_pylist()
            for part in slices(whole):
                texts = whole[part]
                found = encode(texts)
                offsets = np.cumsum([0, *map(len, found)])
                flat = np.concatenate([np.empty(0, np.intc), *found])
                same = [
                    vocabulary.decode(ids.tolist()) == text.replace(MARK, " ")
                    for ids, text in zip(found, texts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part],
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                        pa.array(same, pa.bool_()),
                    ],
                    ["id", "pieces", "intact"],
                )

    return docs.select(
        F.col(key).cast("long").alias("id"), known(F.col(text)).alias("text")
    ).mapInArrow(run, "id long, pieces array<int>, intact boolean")


def decode(
    encoded: DataFrame, key: str = "id", pieces: str = "pieces", path: str | None = None
) -> DataFrame:
    """``id`` and ``text`` of every row of ``encoded``; null pieces count as none, and
    bytes that are no text become replacement characters."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            texts = [vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["id", "text"]
            )

    return encoded.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(pieces), F.array().cast("array<int>")).alias("pieces"),
    ).mapInArrow(run, "id long, text string")


ship(__name__)
