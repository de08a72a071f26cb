"""A numpy FM-index over a bounded sequence of small integers: wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


def suffix_array(seq: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix order by rank doubling; a suffix that ends first comes first.  With depth, suffixes that agree in
    so many symbols may stand in any order."""
    n = len(seq)
    if n < 2:
        return np.arange(n)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
    order, step = np.argsort(rank, kind="stable"), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] if step < n else 0
        key = rank * (n + 2) + ahead
        order = np.argsort(key)
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.r_[1, ordered[1:] != ordered[:-1]])
        if new.max() == n or depth and 2 * step >= depth:
            return order
        rank, step = new, step * 2


class WaveletMatrix:
    """Rank of any symbol before any place, a level a bit of the symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> level) & 1
            ones = np.zeros(len(now) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(now) - int(ones[-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        first = np.zeros(len(symbol), np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            up, first_up = ones[place], ones[first]
            place = np.where(bit, zeros + up, place - up)
            first = np.where(bit, zeros + first_up, first - first_up)
        return place - first


class FMIndex:
    def __init__(self, seq: np.ndarray, size: int):
        """seq: symbols from 0 to size - 1; it is indexed with a symbol of its own at the end."""
        text = np.append(seq.astype(np.int64) + 1, 0)
        order = suffix_array(text)
        self.last = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size + 1))])
        self.wavelet = WaveletMatrix(self.last, size + 1)
        self.sampled = order % SAMPLE_EVERY == 0
        self.sample_rank = np.cumsum(self.sampled) - self.sampled
        self.samples = order[self.sampled]
        self.n = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of each row of phrases (left-aligned, `lengths` symbols each), all rows at once."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (hi > lo))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back] + 1
            both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.before[symbol] + both[: len(live)]
            hi[live] = self.before[symbol] + both[len(live) :]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows, by walking back to the next sampled position."""
        out = np.zeros(len(rows), np.int64)
        rows, steps, left = rows.copy(), 0, np.arange(len(rows))
        while len(left):
            hit = self.sampled[rows]
            out[left[hit]] = (self.samples[self.sample_rank[rows[hit]]] + steps) % self.n
            rows, left = rows[~hit], left[~hit]
            if len(left):
                symbol = self.last[rows]
                rows = self.before[symbol] + self.wavelet.rank(symbol, rows)
            steps += 1
        return out
