"""Byte-level BPE over a public vocabulary, driven by a hierarchical-bitmap rank queue.

A pre-token of ``n`` bytes is a linked list of symbols.  Every adjacent pair
that the vocabulary can merge waits in the bucket of its merge rank; a bitmap
of three levels (64 ranks a word) says which buckets hold something, and
find-first-set on it gives the next rank in constant time.  Positions whose pair
has changed since they were queued are stale and skipped.  A pre-token thus costs
O(n) queue operations instead of the O(n^2) of rescanning all pairs, which is
what very long pre-tokens need.

Whole chunks of text (what stands between two plain spaces) are memoised, so
that a frequent word is encoded once a worker, and a batch of texts is expanded
into ids with a few array operations.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import regex

#: Fixed value: the pre-token pattern that the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A memo is emptied when it holds this many chunks; longer chunks are never kept.
MEMO_CHUNKS = 400_000
MEMO_CHARS = 80


class RankQueue:
    """Buckets of positions by rank; ``pop`` gives the lowest non-empty rank."""

    def __init__(self, ranks: int) -> None:
        words = (ranks >> 6) + 1
        self.low = [0] * words
        self.mid = [0] * ((words >> 6) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.mid[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)

    def pop(self) -> tuple[int, list[int]]:
        group = (self.top & -self.top).bit_length() - 1
        mid = self.mid[group]
        word = (group << 6) | ((mid & -mid).bit_length() - 1)
        low = self.low[word]
        bit = low & -low
        self.low[word] = low ^ bit
        if low == bit:
            self.mid[group] = mid = mid ^ (1 << (word & 63))
            if not mid:
                self.top ^= 1 << group
        rank = (word << 6) | (bit.bit_length() - 1)
        return rank, self.buckets.pop(rank)


class Encoder:
    """Encodes texts under a rank file (``base64-token rank`` lines)."""

    def __init__(self, rank_file: bytes, pattern: str = PATTERN) -> None:
        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines()) if t}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.tokens) + 1)
        self._reset()

    def _reset(self) -> None:
        self.words: dict[str, list[int]] = {}
        self.memo: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.opens = np.zeros(1 << 12, bool)
        self.shuts = np.zeros(1 << 12, bool)
        self.count = 0

    def pretoken(self, raw: bytes) -> list[int]:
        """Ids of one pre-token, given as bytes."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        ranks, tokens, queue = self.ranks, self.tokens, self.queue
        n = len(raw)
        ids = [self.bytes[b] for b in raw]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n
        get, push = ranks.get, queue.push
        for i in range(n - 1):
            rank = get(raw[i : i + 2])
            if rank is not None:
                pair[i] = rank
                push(rank, i)
        while queue.top:
            rank, bucket = queue.pop()
            bucket.sort()
            for k, i in enumerate(bucket):
                if pair[i] != rank:
                    continue
                j = after[i]
                ids[i] = rank
                pair[j] = -1
                after[i] = nxt = after[j]
                lower = False
                if nxt < n:
                    before[nxt] = i
                    new = get(tokens[rank] + tokens[ids[nxt]])
                    pair[i] = -1 if new is None else new
                    if new is not None:
                        push(new, i)
                        lower = new < rank
                else:
                    pair[i] = -1
                prev = before[i]
                if prev >= 0:
                    new = get(tokens[ids[prev]] + tokens[rank])
                    pair[prev] = -1 if new is None else new
                    if new is not None:
                        push(new, prev)
                        lower = lower or new < rank
                if lower:
                    for rest in bucket[k + 1 :]:
                        push(rank, rest)
                    break
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def slow(self, text: str) -> list[int]:
        """Ids of a whole text, pre-token by pre-token."""
        words, out = self.words, []
        for word in self.split(text):
            got = words.get(word)
            if got is None:
                got = self.pretoken(word.encode("utf-8", "replace"))
                if len(word) <= MEMO_CHARS:
                    if len(words) >= MEMO_CHUNKS:
                        words.clear()
                    words[word] = got
            out += got
        return out

    def _learn(self, chunk: str, bare: str) -> int:
        ids = self.slow(chunk)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.int32)])
        if self.count == len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
            self.opens, self.shuts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.opens, self.shuts))
        k = self.count
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[k], self.size[k] = self.used, len(ids)
        self.opens[k] = not bare or bare[0].isspace()
        self.shuts[k] = not bare or bare[-1].isspace()
        self.used += len(ids)
        self.count += 1
        return k

    def _indices(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Memo index of every chunk of every text; first chunk of each text.

        A space starts a new pre-token unless it stands within a run of white
        space, so the chunks between spaces can be encoded apart.
        """
        if self.count > MEMO_CHUNKS or self.used > 64 * MEMO_CHUNKS:
            self._reset()
        parts = [t.split(" ") for t in texts]
        memo, first = self.memo, self.first
        for chunk in set(chain.from_iterable(p[1:] for p in parts)).difference(memo):
            memo[chunk] = self._learn(" " + chunk, chunk)
        for p in parts:
            if p[0] not in first:
                first[p[0]] = k = self._learn(p[0], p[0])
                self.shuts[k] = bool(p[0]) and p[0][-1].isspace()
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
        index = np.fromiter(chain.from_iterable(chain((first[p[0]],), map(memo.__getitem__, p[1:])) for p in parts), np.int64, int(counts.sum()))
        return index, heads

    def _unsafe(self, index: np.ndarray, heads: np.ndarray) -> list[int]:
        """Texts in which a run of white space crosses two chunk borders."""
        bad = np.zeros(len(index), bool)
        bad[1:] = self.shuts[index[:-1]] & self.opens[index[1:]]
        bad[heads] = False
        return np.flatnonzero(np.add.reduceat(bad, heads)).tolist()

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        index, heads = self._indices(texts)
        sizes = self.size[index]
        ends = np.cumsum(sizes)
        where = np.repeat(self.start[index] - (ends - sizes), sizes) + np.arange(ends[-1])
        ids, counts = self.flat[where], np.add.reduceat(sizes, heads)
        bad = self._unsafe(index, heads)
        if bad:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for k in bad:
                parts[k] = np.array(self.slow(texts[k]), np.int32)
                counts[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, counts

    def count_batch(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        index, heads = self._indices(texts)
        counts = np.add.reduceat(self.size[index], heads)
        for k in self._unsafe(index, heads):
            counts[k] = len(self.slow(texts[k]))
        return counts


_CACHE: dict[int, Encoder] = {}


def worker_encoder(rank_file: bytes) -> Encoder:
    """The encoder of this Python worker; it lives as long as the worker does."""
    key = hash(rank_file)
    if key not in _CACHE:
        _CACHE[key] = Encoder(rank_file)
    return _CACHE[key]
