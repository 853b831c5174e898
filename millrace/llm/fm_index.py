"""An FM-index over a sequence of symbols: wavelet-matrix ranks and sampled suffix positions.

Runs of symbols are put one after the other, each closed by a separator. Separators differ from
each other in order of place, so comparisons end at them and no pattern spans two runs. All
searches work on many patterns at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: 64 bits a word, and the count of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.pad(packed, (0, -len(packed) % 8 + 8))
        self.words = packed.view(np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)[:-1]])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Symbols by bit, highest first; each level is stably split by its bit."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start, end = np.zeros_like(i), i
        for bit, bits, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(end)
            start, end = np.where(one, zeros + a, start - a), np.where(one, zeros + b, end - b)
        return end - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it occurs before."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for bit, bits, zeros in self.levels:
            one = bits.get(i)
            a, b = bits.ones(start), bits.ones(i)
            symbol |= one.astype(np.int64) << bit
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return symbol, i - start


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling.

    Symbol 0 separates; separators differ and are ordered by place, so the number of rounds is
    logarithmic in the longest repeat within runs.
    """
    n = len(symbols)
    gaps = symbols == 0
    k = int(gaps.sum())
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols + np.int64(k))
    width = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - width] = rank[width:] + 1
        # Separators are alone in their rank, so what follows them never decides.
        key = rank * np.int64(max(int(rank.max()), n) + 2) + follow
        order = np.argsort(key)
        in_order = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray, sample: int = 16):
        """``symbols``: int64, not empty, runs of symbols from 1 on, each closed by 0."""
        order = suffix_order(symbols)
        self.size, self.sample = len(symbols), sample
        last = symbols[order - 1]  # the symbol before each suffix; before the first, the last separator
        top = int(symbols.max(initial=0))
        self.matrix = WaveletMatrix(last, top)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 2))])
        self.top = top
        # Starts of runs are sampled too: steps to the left end there and never cross a separator.
        sampled = (order % sample == 0) | (last == 0)
        self.sampled, self.places = Bits(sampled), order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the suffix interval of every pattern, rows padded on the left."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        live = np.arange(len(patterns))
        for step in range(1, patterns.shape[1] + 1):
            live = live[(lengths[live] >= step) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = patterns[live, -step]
            known = symbol <= self.top
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.matrix.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The start positions of suffixes, by steps to the left up to a sampled one."""
        places, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        rows, live = rows.copy(), np.arange(len(rows))
        while len(live):
            here = rows[live]
            done = self.sampled.get(here)
            places[live[done]] = self.places[self.sampled.ones(here[done])] + steps[live[done]]
            live = live[~done]
            symbol, rank = self.matrix.access(rows[live])
            rows[live] = self.before[symbol] + rank
            steps[live] += 1
        return places
