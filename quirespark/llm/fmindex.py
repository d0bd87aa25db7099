"""An FM-index over a text of small integers: wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text`` by prefix doubling; a shorter suffix comes first."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    step = 1
    while n > 1:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], sorted_key[1:] != sorted_key[:-1]]))
        step *= 2
        if rank[order[-1]] == n or step >= n:
            break
    return order


class WaveletMatrix:
    """``rank`` and ``access`` over a sequence, one bit level after the other, for arrays of queries."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for shift in range(bits - 1, -1, -1):
            bit = (values >> shift) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int64)
            zeros = len(values) - int(ones[-1])
            self.levels.append((shift, ones, zeros))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        begins = np.zeros_like(ends)
        for shift, ones, zeros in self.levels:
            one = (symbols >> shift) & 1 == 1
            a, b = ones[begins], ones[ends]
            begins = np.where(one, zeros + a, begins - a)
            ends = np.where(one, zeros + b, ends - b)
        return ends - begins

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at each place, how often it occurs before)."""
        symbols, begins = np.zeros_like(at), np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            a, b, c = ones[begins], ones[at], ones[at + 1]
            one = c > b
            symbols = symbols | (one.astype(np.int64) << shift)
            begins = np.where(one, zeros + a, begins - a)
            at = np.where(one, zeros + b, at - b)
        return symbols, at - begins


class FMIndex:
    """Index of ``text`` (integers from 1; 0 is kept for the end)."""

    def __init__(self, text: np.ndarray, every: int = 16) -> None:
        text = np.concatenate([text.astype(np.int64), [0]])
        order = suffix_array(text)
        last = text[order - 1]
        self.size = len(text)
        alphabet = int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))]).astype(np.int64)
        self.wavelet = WaveletMatrix(last, max(1, int(alphabet - 1).bit_length()))
        sampled = order % every == 0
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)]).astype(np.int64)
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffix ranks (from, to) of each row of ``phrases``, by backward search."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        known = len(self.before) - 1
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, k]
            inside = symbol < known
            gone = alive[~inside]
            lo[gone] = hi[gone] = 0
            alive, symbol = alive[inside], symbol[inside]
            lo[alive] = self.before[symbol] + self.wavelet.rank(symbol, lo[alive])
            hi[alive] = self.before[symbol] + self.wavelet.rank(symbol, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        return lo, np.maximum(lo, hi)

    def locate(self, ranks: np.ndarray) -> np.ndarray:
        """Text position of each suffix rank: walk back to the next sampled position."""
        where = np.zeros(len(ranks), np.int64)
        at, open_ = ranks.copy(), np.arange(len(ranks))
        steps = 0
        while len(open_):
            done = self.sampled[at]
            where[open_[done]] = (self.samples[self.sample_rank[at[done]]] + steps) % self.size
            open_, at = open_[~done], at[~done]
            if len(open_):
                symbol, count = self.wavelet.access(at)
                at = self.before[symbol] + count
                steps += 1
        return where
