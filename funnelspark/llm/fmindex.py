"""FM-index over a shard of documents: suffix order, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(text: np.ndarray, top: int) -> np.ndarray:
    """Starts of the suffixes in lexicographic order. ``text`` ends in its only 0; symbols are at most ``top``.

    The first sort packs as many symbols as fit into 63 bits; then the compared length doubles, for suffixes that still tie only.
    """
    n, bits = len(text), max(1, int(top).bit_length())
    width = max(1, min(63 // bits, n))
    key = np.zeros(n, dtype=np.int64)
    for k in range(width):
        key <<= bits
        key[: n - k] |= text[k:]
    order = np.argsort(key)
    key = key[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    length = width
    open_ = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while len(open_):
        suffix = order[open_]
        key = rank[suffix] * n + rank[suffix + length]
        by = np.argsort(key)
        key, suffix = key[by], suffix[by]
        order[open_] = suffix
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank[suffix] = np.maximum.accumulate(np.where(new, open_, 0))
        length *= 2
        open_ = open_[~(new & np.append(new[1:], True))]
    return order


class WaveletMatrix:
    """Ranks of any symbol in a sequence: one bit vector a level, 64 bits a word with the counts before each word."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels = []
        rest = sequence.astype(np.uint32)
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (rest >> np.uint32(shift)) & np.uint32(1) != 0
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(packed) // 8 + 2, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            zeros = np.flatnonzero(~bit)
            self.levels.append((shift, words, before, len(zeros)))
            rest = np.concatenate([rest[zeros], rest[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(words[block] & mask)

    def rank(self, symbol: np.ndarray, *at: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands before each position."""
        places = [np.zeros(len(symbol), dtype=np.int64), *at]
        for shift, words, before, zeros in self.levels:
            one = (symbol >> shift) & 1 != 0
            for k, p in enumerate(places):
                ones = self._ones(words, before, p)
                places[k] = np.where(one, zeros + ones, p - ones)
        return [p - places[0] for p in places[1:]]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the positions."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for shift, words, before, zeros in self.levels:
            one = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
            ones = self._ones(words, before, at)
            at = np.where(one, zeros + ones, at - ones)
            symbol |= one.astype(np.int64) << shift
        return symbol


class FMIndex:
    """Counts and locates phrases of a symbol sequence (symbols from 1 on)."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = SAMPLE):
        text = np.append(symbols, 0)
        order = suffix_order(text, top)
        self.size = len(text)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.wavelet = WaveletMatrix(text[order - 1], top)
        self.sampled = order % sample == 0
        self.nth = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases (rows, filled up at the end), by backward steps over all phrases at once."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.size, dtype=np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > step) & (low < high))
            symbol = phrases[live, lengths[live] - 1 - step]
            a, b = self.wavelet.rank(symbol, low[live], high[live])
            low[live], high[live] = self.below[symbol] + a, self.below[symbol] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to a sampled suffix."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        walking = np.flatnonzero(~self.sampled[at])
        while len(walking):
            here = at[walking]
            symbol = self.wavelet.access(here)
            (before,) = self.wavelet.rank(symbol, here)
            at[walking] = self.below[symbol] + before
            steps[walking] += 1
            walking = walking[~self.sampled[at[walking]]]
        return self.positions[self.nth[at]] + steps
