"""FM-index of a shard: texts as sequences of symbols from 1 on, a separator (0) before, between and behind them.

Suffixes are ordered by prefix doubling, each separator a symbol of its own, so that only suffixes with equal starts
within a text are sorted again. The Burrows-Wheeler sequence is kept as a wavelet tree in level order: level l holds one
bit of every symbol, stably sorted by the bits of the levels above, with ones counted before every 64-bit word; a rank
goes down one place a level. Suffix positions are kept for every ``rate``-th place and for places behind a separator;
others are found by stepping backwards through the text to such a place. Whole arrays of patterns, rows and places
are worked on at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit sequence with ranks."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int32)
        self.before = np.concatenate([np.zeros(1, np.int32), upto[:-1]])
        self.zeros = len(bits) - int(upto[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many bits before each place are set."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.shifts = list(range(max(1, (n_symbols - 1).bit_length())))[::-1]
        self.levels, now = [], symbols
        for shift in self.shifts:
            bits = (now >> shift & 1).astype(bool)
            self.levels.append(Bits(bits))
            now = np.concatenate([now[~bits], now[bits]])
        everything = np.arange(n_symbols)
        self.start = self._down(everything, np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, level in zip(self.shifts, self.levels):
            ones = level.ones(at)
            at = np.where(symbols >> shift & 1, level.zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbols, at) - self.start[symbols]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbols = np.zeros(len(at), np.int64)
        for level in self.levels:
            ones, bit = level.ones(at), level.at(at)
            at = np.where(bit, level.zeros + ones, at - ones)
            symbols = symbols << 1 | bit
        return symbols, at - self.start[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order; the text ends with a separator, and separators order by place."""
    n, breaks = len(text), text == 0
    own = np.cumsum(breaks)
    symbol = np.where(breaks, own - 1, text + own[-1] - 1)
    order = np.argsort(symbol).astype(np.int32)
    rank, rows, key, places = np.empty(n, np.int32), np.arange(n), symbol[order], order
    k = 0
    while len(rows):
        if k:
            places = order[rows]
            # equal starts of k symbols hold no separator, so there is a place behind them
            key = rank[places].astype(np.int64) * n + rank[places + k]
            by = np.argsort(key)
            places, key = places[by], key[by]
            order[rows] = places
        head = np.ones(len(rows), bool)
        head[1:] = key[1:] != key[:-1]
        rank[places] = rows[np.maximum.accumulate(np.where(head, np.arange(len(rows)), 0))]
        alone = head.copy()
        alone[:-1] &= head[1:]
        rows = rows[~alone]
        k = 2 * k or 1
    return order


class FMIndex:
    def __init__(self, text: np.ndarray, n_symbols: int, rate: int = 8):
        """``text``: symbols below n_symbols, its first and last one a separator."""
        order = suffix_order(text)
        last = text[order - 1]
        self.tree = WaveletTree(last, n_symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        known = (order % rate == 0) | (last == 0)
        self.known, self.places = Bits(known), order[known]

    def find(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each pattern (one a line), by backward search."""
        low, high = self.below[patterns[:, -1]], self.below[patterns[:, -1] + 1]
        open_ = np.flatnonzero(low < high)
        for c in patterns.T[-2::-1]:
            c = c[open_]
            low[open_] = self.below[c] + self.tree.rank(c, low[open_])
            high[open_] = self.below[c] + self.tree.rank(c, high[open_])
            open_ = open_[low[open_] < high[open_]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the text of each row's suffix."""
        out, steps = np.empty(len(rows), np.int64), 0
        left, rows = np.arange(len(rows)), rows.copy()
        while len(left):
            there = self.known.at(rows)
            out[left[there]] = self.places[self.known.ones(rows[there])] + steps
            left, rows = left[~there], rows[~there]
            if len(left):
                symbols, rank = self.tree.read(rows)
                rows, steps = self.below[symbols] + rank, steps + 1
        return out

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, place) of every occurrence."""
        low, high = self.find(patterns)
        many = high - low
        which = np.repeat(np.arange(len(patterns)), many)
        ends = np.cumsum(many)
        rows = np.arange(len(which)) - np.repeat(ends - many, many) + np.repeat(low, many)
        return which, self.locate(rows)
