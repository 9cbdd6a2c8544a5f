"""Token counts of whole texts by looking up the lengths of their pre-tokens.

Two tiers, and no pre-token leaves its task. The first is a compact hash table,
broadcast, of the pre-tokens that a tokenizer's own vocabulary holds whole: those its
makers found frequent. It has at most as many entries as the vocabulary. The second is
a cache in each worker; what is in neither table is encoded by the tokenizer library
once and remembered. Neither table changes a result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import known, ship

# Entries a worker's cache may hold before it starts anew.
CACHED = 1_000_000
# White space as the tokenizer's pattern has it, and its rules for it: one
# space goes with what follows, other white space stays alone. Between a letter and a
# mark there is always a cut; a run of other characters is cut further by the library,
# in the same way wherever it stands.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
_MARK = "!-&(-/:-@[-`{-~"
_WORD = f" ?[{_LETTER}]+(?=[{_SPACE}{_MARK}]|\\Z)"
_CHUNK = f"{_WORD}| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [byte for byte in range(256) if byte not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def frequent_lengths(path: str) -> dict[str, int]:
    """The lengths in tokens of the vocabulary's entries that are pre-tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    bytes_of = {letter: byte for byte, letter in _byte_letters().items()}
    whole = re.compile(_WORD)
    words = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            word = bytes(bytes_of[letter] for letter in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if whole.fullmatch(word):
            words.append(word)
    encoded = tokenizer.encode_batch(sorted(words), add_special_tokens=False)
    return {word: len(e.ids) for word, e in zip(sorted(words), encoded, strict=True)}


def counter(frequent: dict[str, int], path: str) -> Callable[[list[str]], list[int]]:
    """A function that counts the tokens of texts, with ``frequent`` lengths known."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    model, letters = tokenizer.model, _byte_letters()
    find, is_word = re.compile(_CHUNK).findall, re.compile(_WORD).fullmatch

    class Lengths(dict):
        def __missing__(self, chunk: str) -> int:
            if is_word(chunk):
                size = len(model.tokenize(chunk.encode().decode("latin-1").translate(letters)))
            else:
                size = len(tokenizer.encode(chunk, add_special_tokens=False).ids)
            if len(self) > CACHED + len(frequent):
                self.clear()
                self.update(frequent)
            self[chunk] = size
            return size

    lookup = Lengths(frequent).__getitem__

    def count(texts: list[str]) -> list[int]:
        return [
            len(tokenizer.encode(text, add_special_tokens=False).ids)
            if any(s in text for s in special)
            else sum(map(lookup, find(text)))
            for text in texts
        ]

    return count


def count_tokens(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    limit: int = 512,
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    Counts are those of the tokenizer library for the byte-level tokenizer file at
    ``path``, without added tokens; strings of special tokens inside a text count as
    these tokens. Null texts count as empty and have no tokens. Rows that repeat are
    each counted; an empty table gives no rows; other columns are not read. Workers
    read ``path`` themselves.
    """
    path = path or tokenizer_path()
    broadcast = docs.sparkSession.sparkContext.broadcast(frequent_lengths(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(broadcast.value, path)
        for batch in batches:
            counts = count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(
        F.col(key).cast("long").alias("id"),
        known(F.col(text)).alias("text"),
        F.octet_length(known(F.col(text))).cast("long").alias("n_bytes"),
    ).mapInArrow(run, "id long, n_bytes long, n_tokens long, over_limit boolean")


ship(__name__)
