"""An FM-index over integer symbols: suffix array, wavelet-tree ranks,
backward search and location by sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: A suffix position is kept for every SAMPLE-th text position.
SAMPLE = 16


class Bits:
    """A bit vector with constant-time rank, a count per 64 bits."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((bits.size // 64 + 1) * 64, np.uint8)
        padded[: bits.size] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """A wavelet tree stored level by level, highest bit first; at each level
    the zeros stand before the ones."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.width, self.levels = width, []
        now = symbols
        for level in range(width - 1, -1, -1):
            bit = (now >> level & 1).astype(np.uint8)
            self.levels.append((Bits(bit), int(bit.size - bit.sum())))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``at`` symbols."""
        low, high = np.zeros_like(at), at
        for level, (bits, zeros) in zip(range(self.width - 1, -1, -1), self.levels):
            one = (symbol >> level & 1).astype(bool)
            a, b = bits.rank(low), bits.rank(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def get(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        symbol = np.zeros_like(at)
        for bits, zeros in self.levels:
            one = bits.get(at).astype(np.int64)
            ones = bits.rank(at)
            symbol = symbol << 1 | one
            at = np.where(one == 1, zeros + ones, at - ones)
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes whose rank is still
    shared are sorted again. The last symbol is unique and smallest."""
    n = text.size
    order = np.argsort(text, kind="stable")
    fresh = np.concatenate(([True], text[order][1:] != text[order][:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    places = np.flatnonzero(~(fresh & np.concatenate((fresh[1:], [True]))))
    step = 1
    while places.size:
        open_ = order[places]
        ahead = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + ahead
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        order[places] = open_
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[open_] = np.maximum.accumulate(np.where(fresh, places, 0))
        places = places[~(fresh & np.concatenate((fresh[1:], [True])))]
        step *= 2
    return order


class FMIndex:
    """Index of ``text``, integer symbols from 1 to ``largest``."""

    def __init__(self, text: np.ndarray, largest: int):
        text = np.append(text, 0).astype(np.int64)
        order = suffix_array(text)
        last = text[order - 1]
        self.size = text.size
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        self.tree = Wavelet(last, max(1, int(largest).bit_length()))
        sampled = order % SAMPLE == 0
        self.marked, self.samples = Bits(sampled.astype(np.uint8)), order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each pattern; ``patterns`` is a matrix with one
        pattern of one length in each row."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        live = np.arange(len(patterns))
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, column]
            ranks = self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((low[live], high[live])))
            low[live] = self.less[symbol] + ranks[: live.size]
            high[live] = self.less[symbol] + ranks[live.size :]
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back to a sampled position."""
        rows, steps = rows.copy(), np.zeros(rows.size, np.int64)
        walking = np.arange(rows.size)
        while True:
            walking = walking[self.marked.get(rows[walking]) == 0]
            if not walking.size:
                break
            at = rows[walking]
            symbol = self.tree.get(at)
            rows[walking] = self.less[symbol] + self.tree.rank(symbol, at)
            steps[walking] += 1
        return self.samples[self.marked.rank(rows)] + steps
