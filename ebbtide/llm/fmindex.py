"""A full-text index over numbers, compressed, searched for many patterns in step."""

from __future__ import annotations

import numpy as np

from ebbtide.llm.shared import ship

_ONE = np.uint64(1)
_LOW = np.uint64(63)


class WaveletTree:
    """Ranks of symbols in a sequence: one bit per level and place, in words of 64 with
    the ones before each. Levels split by the next lower bit of a symbol, zeros first."""

    def __init__(self, values: np.ndarray, depth: int):
        self.depth, self.planes, self.zeros = depth, [], []
        for level in range(depth - 1, -1, -1):
            bits = ((values >> level) & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=ones[1:])
            self.planes.append((words, ones))
            self.zeros.append(len(values) - int(bits.sum()))
            values = np.concatenate([values[~bits], values[bits]])

    def starts(self, symbols: np.ndarray) -> np.ndarray:
        """Where each symbol's places begin in the last level."""
        return self._descend(symbols, np.zeros(len(symbols), np.int64))

    def _descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for n, (words, ones) in enumerate(self.planes):
            slot = places >> 6
            below = words[slot] & ((_ONE << (places.astype(np.uint64) & _LOW)) - _ONE)
            before = ones[slot] + np.bitwise_count(below)
            bit = (symbols >> (self.depth - 1 - n)) & 1
            places = np.where(bit == 1, self.zeros[n] + before, places - before)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._descend(symbols, places) - starts


def _order(text: np.ndarray, depth: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffixes in the order of their first ``depth`` symbols, by doubling; the number
    of each suffix's first 1, 2, 4 ... symbols among those of all."""
    rank = text.astype(np.int64)
    length, ranks = 1, {1: rank}
    order = np.argsort(rank, kind="stable")
    while length < depth:
        after = np.zeros(len(text), np.int64)
        after[:-length] = rank[length:] + 1
        both = rank * (len(text) + 2 + int(text.max())) + after
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        length *= 2
        ranks[length] = rank
    return order, ranks


class Index:
    """An FM-index of sequences of numbers from 1 on, each with an owner.

    Sequences stand one after the other behind a 0. Suffixes are sorted by their first
    symbols only, as many as the longest pattern has, which leaves backward search
    exact for patterns up to that length. Kept are the wavelet tree of the symbols
    before the suffixes, where each symbol's suffixes begin, where suffixes differ in
    their first ``length - 1`` symbols, and the least owner of those that share
    ``length``.
    """

    def __init__(self, text: np.ndarray, owners: np.ndarray, length: int):
        self.length = length
        order, ranks = _order(text, length)
        self.tree = WaveletTree(text[order - 1], max(1, int(text.max()).bit_length()))
        counts = np.bincount(text, minlength=int(text.max()) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])

        def edges(symbols: int) -> np.ndarray:
            """Bounds between suffixes that differ in their first ``symbols``."""
            power = 1 << (symbols.bit_length() - 1)
            shift = symbols - power
            one = ranks[power]
            two = np.full(len(text), -1, np.int64)
            two[: len(text) - shift] = one[shift:]
            differ = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
            return np.concatenate([[0], np.flatnonzero(differ) + 1, [len(text)]])

        self.wide = edges(length - 1) if length > 1 else np.array([0, len(text)])
        self.same = edges(length)
        self.least = np.minimum.reduceat(owners[order], self.same[:-1])

    def least_owners(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For every place of the patterns ``text[start : start + size]`` the least owner
        of an indexed window of ``length`` symbols equal to the one there; the largest
        number where no window is left or none is equal.

        Patterns are read from their ends, all in step: each symbol extends the match
        to the left (backward search). Once a match is ``length`` long its last symbol
        is given up first, by widening the interval to the suffixes that share the
        others. An interval that runs empty starts again behind the symbol.
        """
        none = np.iinfo(np.int64).max
        out = np.full(len(text), none, np.int64)
        turn = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[turn], sizes[turn]
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), self.same[-1], np.int64)
        match = np.zeros(len(starts), np.int64)
        level = self.tree.starts(np.arange(len(self.first) - 1))
        for step in range(1, int(sizes.max(initial=0)) + 1):
            live = int(np.searchsorted(-sizes, -step, "right"))
            low, high, match = low[:live], high[:live], match[:live]
            place = starts[:live] + sizes[:live] - step
            symbol = text[place]
            full = np.flatnonzero(match == self.length)
            group = np.searchsorted(self.wide, low[full], "right") - 1
            low[full], high[full] = self.wide[group], self.wide[group + 1]
            match[full] -= 1
            first, base = self.first[symbol], level[symbol]
            low = first + self.tree.rank(symbol, low, base)
            high = first + self.tree.rank(symbol, high, base)
            empty = low >= high
            low[empty], high[empty] = 0, self.same[-1]
            match = np.where(empty, 0, match + 1)
            full = np.flatnonzero(match == self.length)
            group = np.searchsorted(self.same, low[full], "right") - 1
            out[place[full]] = self.least[group]
        return out


ship(__name__)
