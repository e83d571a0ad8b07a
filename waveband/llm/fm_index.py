"""FM-index over the word symbols of one shard of texts.

Symbols are positive numbers; 0 is a separator, of which every occurrence is unique, so
nothing matches across it. The text ends with a separator. The index keeps the wavelet
matrix of the Burrows-Wheeler transform (one array of zero counts per bit), the first row
of each symbol, and the text positions of sampled rows.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Text positions in the order of their suffixes, by doubling the compared length.

    Only suffixes that still tie are sorted again. A separator in the compared part makes a
    suffix unique, so the rank at ``position + step`` always exists.
    """
    n = len(text)
    counts = np.bincount(text)
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    separator = text == 0
    rank = before[text]
    rank[separator] = np.arange(counts[0])
    active = np.flatnonzero(~separator & (counts[text] > 1))
    step = 1
    while len(active):
        own, following = rank[active], rank[active + step]
        order = np.lexsort((following, own))
        active, own, following = active[order], own[order], following[order]
        at = np.arange(len(active))
        group = np.ones(len(active), bool)
        group[1:] = own[1:] != own[:-1]
        part = group.copy()
        part[1:] |= following[1:] != following[:-1]
        rank[active] = own + np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        alone = part & np.append(part[1:], True)
        active = active[~alone]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class FMIndex:
    """Count and locate phrases; all queries of a call are answered together."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample_every: int = 16):
        order = suffix_order(text)
        previous = text[order - 1]  # the transform; position 0 wraps to the last separator
        self.n = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        # a walk backwards ends at a sample, and every position after a separator is one
        self.is_sample = (order % sample_every == 0) | (previous == 0)
        self.sample_rank = np.cumsum(self.is_sample, dtype=np.int32) - 1
        self.samples = order[self.is_sample]

        self.bits = max(1, int(n_symbols).bit_length())
        self.zeros: list[np.ndarray] = []
        level = previous.astype(np.int32)
        for bit in reversed(range(self.bits)):
            one = (level >> bit) & 1 == 1
            sums = np.zeros(self.n + 1, np.int32)
            np.cumsum(~one, out=sums[1:])
            self.zeros.append(sums)
            level = np.concatenate([level[~one], level[one]])
        self.start = self._descend(np.arange(n_symbols + 1), np.zeros(n_symbols + 1, np.int64))

    def _descend(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        for sums, bit in zip(self.zeros, reversed(range(self.bits)), strict=True):
            zeros = sums[rows]
            rows = np.where((symbols >> bit) & 1 == 1, sums[-1] + rows - zeros, zeros)
        return rows

    def rank(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each row."""
        return self._descend(symbols, rows) - self.start[symbols]

    def _symbol_and_rank(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols = np.zeros(len(rows), np.int64)
        for sums, bit in zip(self.zeros, reversed(range(self.bits)), strict=True):
            zeros = sums[rows]
            one = sums[rows + 1] == zeros
            symbols |= one.astype(np.int64) << bit
            rows = np.where(one, sums[-1] + rows - zeros, zeros)
        return symbols, rows - self.start[symbols]

    def rows_of(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the first and end row of each phrase (the phrases have one length)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            symbols = phrases[alive, k]
            low[alive] = self.first[symbols] + self.rank(symbols, low[alive])
            high[alive] = self.first[symbols] + self.rank(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a sampled row and add the steps."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.is_sample[rows])
        while len(walking):
            symbols, rank = self._symbol_and_rank(rows[walking])
            rows[walking] = self.first[symbols] + rank
            steps[walking] += 1
            walking = walking[~self.is_sample[rows[walking]]]
        return self.samples[self.sample_rank[rows]] + steps
