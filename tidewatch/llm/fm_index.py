"""An FM-index over a sequence of small integers: suffix array, wavelet matrix, backward search, located hits."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling. Each 0 is a separator of its own, ordered by place, so no comparison passes one."""
    n = len(symbols)
    zero = symbols == 0
    rank = np.where(zero, np.cumsum(zero) - 1, symbols.astype(np.int64) + int(zero.sum()))
    step, order = 1, np.argsort(rank, kind="stable")
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        order = np.lexsort((after, rank))
        first, second = rank[order], after[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(fresh) - 1
        rank = new
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of any symbol before any place, one bit vector with counts per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        self.start = np.zeros(size, np.int64)
        codes = np.arange(size, dtype=np.int64)
        left = symbols.astype(np.int64)
        for bit in reversed(range(max(1, int(size - 1).bit_length()))):
            ones = (left >> bit) & 1
            count = np.zeros(len(left) + 1, np.int32)
            np.cumsum(ones, out=count[1:])
            zeros = len(left) - int(count[-1])
            self.levels.append((bit, count, zeros))
            self.start = np.where((codes >> bit) & 1, zeros + count[self.start], self.start - count[self.start])
            left = np.concatenate([left[ones == 0], left[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        at = place
        for bit, count, zeros in self.levels:
            ones = count[at]
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at - self.start[symbol]


class FmIndex:
    """Index of runs of symbols 1 to ``size - 1``, with 0 between runs and at the end.

    Suffixes that start at every ``rate``-th place of a run are sampled, its first place always, so that
    walking back from a hit never leaves its run.
    """

    def __init__(self, symbols: np.ndarray, size: int, rate: int = 4):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])[:size]
        self.tree = WaveletMatrix(self.last, size)
        places = np.arange(len(symbols))
        begin = np.maximum.accumulate(np.where(symbols == 0, places + 1, 0))
        begin = np.concatenate([[0], begin[:-1]])
        kept = ((places - begin) % rate == 0)[order]
        self.sampled = np.where(kept, order, -1)

    def _back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.tree.rank(symbol, row)

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of equally long phrases, one a row, by backward search."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        for column in reversed(range(phrases.shape[1])):
            low, high = self._back(phrases[:, column], low), self._back(phrases[:, column], high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffixes given by their rank."""
        found = self.sampled[rows].copy()
        steps = np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(found < 0)
        at = rows[open_]
        walked = 0
        while len(open_):
            at = self._back(self.last[at], at)
            walked += 1
            got = self.sampled[at]
            done = got >= 0
            found[open_[done]] = got[done]
            steps[open_[done]] = walked
            open_, at = open_[~done], at[~done]
        return found + steps

    def hits(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``phrases``, place) of every occurrence."""
        low, high = self.ranges(phrases)
        count = high - low
        which = np.repeat(np.arange(len(phrases)), count)
        rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return which, self.locate(rows)
