"""Problem 8: passages of evaluation items that stand in corpus documents.

Twenty passage words in a row with one word changed, dropped or added hold at
least ten words in a row unaltered.  The documents of a task are therefore
reduced, without loss, to their runs of ten or more words whose neighbours also
follow each other somewhere in the passages; an FM-index of each shard of such
runs is searched backwards for phrases of eight words taken every third word of
each passage, one of which lies within any ten words.  Occurrences are located
by sampled suffix positions, extended exactly with at most one altered word,
and the spans that reach twenty words are merged.  Map only: nothing is shuffled.
"""

from __future__ import annotations

import html
import pickle
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .batches import pieces
from .confusables import PROTOTYPE, fold
from .fmindex import FMIndex

WORDS = 20
RUN = 10
PHRASE = 8
STRIDE = 3
#: Words of documents that are indexed together.
SHARD_WORDS = 1_500_000
#: Items that are broadcast together; more are searched for in blocks.
BLOCK_ITEMS = 20_000
MEMO = 400_000
#: Occurrences with their items that are looked at together.
OWNERS = 1_000_000

_TAG = regex.compile(r"</?[A-Za-z][^<>]*>")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_MARK = regex.compile(r"\p{M}+")
# Small Cyrillic letters whose capitals look like a Latin capital.
_SMALL = str.maketrans("вкмнт", "bkmht")


def bare(text: str) -> str:
    """A text without tags, with character references resolved."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    return html.unescape(text) if "&" in text else text


def words(text: str) -> list[str]:
    """Words of a text without case, marks, markup, invisible characters and look-alikes."""
    text = bare(text)
    if not text.isascii():
        text = _MARK.sub("", unicodedata.normalize("NFD", fold(text)))
        text = "".join(PROTOTYPE.get(c, c) for c in text).lower().translate(_SMALL)
    return _WORD.findall(text.lower())


class Passages:
    """The passages of a block of items as integers, with their neighbour pairs and phrases."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.vocabulary: dict[str, int] = {}
        self.items: list[int] = []
        self.texts: list[np.ndarray] = []
        for item, text in items:
            lines = (text or "").replace("\r\n", "\n").split("\n")
            passage = words("\n".join(lines[1:-1]) if len(lines) > 2 else text or "")
            if len(passage) >= WORDS:
                self.items.append(item)
                self.texts.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in passage], np.int64))
        size = len(self.vocabulary) + 2
        pairs = [t[:-1] * size + t[1:] for t in self.texts]
        self.size = size
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        phrases, owners = [], []
        for k, t in enumerate(self.texts):
            for at in range(0, len(t) - PHRASE + 1, STRIDE):
                phrases.append(t[at : at + PHRASE])
                owners.append((k, at))
        self.phrases, inverse = np.unique(np.array(phrases).reshape(-1, PHRASE), axis=0, return_inverse=True)
        order = np.argsort(inverse.ravel(), kind="stable")
        self.owners = np.array(owners, np.int64).reshape(-1, 2)[order]
        self.owner_heads = np.concatenate([[0], np.cumsum(np.bincount(inverse.ravel(), minlength=len(self.phrases)))]).astype(np.int64)
        bits = max(16, int(len(self.pairs) * 16).bit_length())
        self.mask = (1 << bits) - 1
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self._slot(self.pairs)] = True
        self._reset()

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair * 0x9E3779B1) >> 7) & self.mask

    def _reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.start, self.count, self.flat = [], [], []

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts, number of words of each); 1 is any word of no passage."""
        chunks: list[str] = []
        sizes = []
        for text in texts:
            own = bare(text).split()
            sizes.append(len(own))
            chunks += own
        new = set(chunks).difference(self.memo)
        if len(self.memo) + len(new) > MEMO and self.memo:
            self._reset()
            new = set(chunks)
        get = self.vocabulary.get
        for chunk in new:
            got = [get(w, 1) for w in words(chunk)]
            self.memo[chunk] = len(self.start)
            self.start.append(len(self.flat))
            self.count.append(len(got))
            self.flat += got
        index = np.fromiter(map(self.memo.__getitem__, chunks), np.int64, len(chunks))
        start, count, flat = (np.array(x, np.int64) for x in (self.start, self.count, self.flat))
        per = count[index]
        ends = np.cumsum(per)
        total = int(ends[-1]) if len(ends) else 0
        out = flat[np.repeat(start[index] - (ends - per), per) + np.arange(total)] if total else np.zeros(0, np.int64)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return out, np.diff(edges)

    def runs(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(from, to) of the runs of at least ``RUN`` words whose neighbours are neighbours in a passage."""
        if len(ids) < RUN:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = ids[:-1] * self.size + ids[1:]
        good = (ids[:-1] > 1) & (ids[1:] > 1) & self.seen[self._slot(pair)]
        borders = np.cumsum(sizes)[:-1] - 1
        good[borders[(borders >= 0) & (borders < len(good))]] = False
        padded = np.concatenate([[False], good, [False]]).astype(np.int8)
        change = np.diff(padded)
        begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        keep = end - begin >= RUN - 1
        return begin[keep], end[keep] + 1


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two arrays."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def extend(doc: np.ndarray, at: int, passage: np.ndarray, off: int) -> tuple[int, int, int]:
    """(passage words covered, from, to) around ``doc[at] == passage[off]`` with at most one altered word between equal ones."""
    back = _same(doc[:at][::-1], passage[:off][::-1])
    ahead = _same(doc[at:], passage[off:])
    a, b = at - back, at + ahead
    pa_, pb = off - back, off + ahead
    best = (pb - pa_, a, b)
    for skip_doc, skip_passage in ((1, 1), (0, 1), (1, 0)):
        more = _same(doc[b + skip_doc :], passage[pb + skip_passage :])
        if more:
            best = max(best, (pb + skip_passage + more - pa_, a, b + skip_doc + more))
        more = _same(doc[: max(0, a - skip_doc)][::-1], passage[: max(0, pa_ - skip_passage)][::-1])
        if more:
            best = max(best, (pb - pa_ + skip_passage + more, a - skip_doc - more, b))
    return best


def search_shard(passages: Passages, ids: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, item, from word, to word) of every passage part of ``WORDS`` words in a shard."""
    ids = ids.astype(np.int64)
    begin, end = passages.runs(ids, sizes)
    if not len(begin) or not len(passages.phrases):
        return []
    lengths = end - begin
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.ones(int((lengths + 1).sum()), np.int64)
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    text[np.repeat(starts, lengths) + inner] = ids[np.repeat(begin, lengths) + inner]
    index = FMIndex(text)
    lo, hi = index.search(passages.phrases)
    hit = np.flatnonzero(hi > lo)
    if not len(hit):
        return []
    many = hi[hit] - lo[hit]
    ranks = np.repeat(lo[hit] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    place = index.locate(ranks)
    phrase = np.repeat(hit, many)
    run = np.searchsorted(starts, place, side="right") - 1
    word = begin[run] + place - starts[run]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.searchsorted(edges, word, side="right") - 1
    # Each occurrence belongs to every item that has the phrase.  Owners are only
    # spread out for a few documents at a time, so that a phrase which many items
    # share and many documents hold does not multiply in memory.
    order = np.argsort(doc, kind="stable")
    phrase, word, doc = phrase[order], word[order], doc[order]
    own = passages.owner_heads[phrase + 1] - passages.owner_heads[phrase]
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    reach = np.cumsum(own)
    out: list[tuple[int, int, int, int]] = []
    at = 0
    while at < len(doc):
        done = int(reach[at - 1]) if at else 0
        end = int(np.searchsorted(reach, done + OWNERS, side="right"))
        nxt = int(np.searchsorted(heads, end, side="right")) - 1
        end = int(heads[nxt]) if heads[nxt] > at else int(heads[nxt + 1]) if nxt + 1 < len(heads) else len(doc)
        end = len(doc) if reach[-1] <= done + OWNERS else end
        out += _owned(passages, ids, edges, phrase[at:end], word[at:end], doc[at:end])
        at = end
    return out


def _owned(passages: Passages, ids: np.ndarray, edges: np.ndarray, phrase: np.ndarray, word: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The found parts of whole documents: occurrences on one diagonal of a document and item are extended once for each stretch."""
    own = passages.owner_heads[phrase + 1] - passages.owner_heads[phrase]
    pick = np.repeat(passages.owner_heads[phrase] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
    item, off = passages.owners[pick, 0], passages.owners[pick, 1]
    word, doc = np.repeat(word, own), np.repeat(doc, own)
    order = np.lexsort((word, word - off, item, doc))
    out, last, covered = [], None, -1
    for k in order.tolist():
        d, i, w, o = int(doc[k]), int(item[k]), int(word[k]), int(off[k])
        if (d, i, w - o) == last and w < covered:
            continue
        base = int(edges[d])
        got, a, b = extend(ids[base : int(edges[d + 1])], w - base, passages.texts[i], o)
        last, covered = (d, i, w - o), base + b
        if got >= WORDS:
            out.append((d, passages.items[i], a, b))
    return out


_PASSAGES: dict[int, Passages] = {}


def _worker_passages(raw: bytes) -> Passages:
    key = hash(raw)
    if key not in _PASSAGES:
        _PASSAGES.clear()
        _PASSAGES[key] = Passages(pickle.loads(raw))
    return _PASSAGES[key]


def spans(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, from_word, to_word``: parts of passages in documents, words counted from 0.

    A passage is what stands between the first and the last line of an item; an
    item of fewer lines is a passage as a whole, and one of fewer than
    ``WORDS`` words is never found.  NULL and empty texts hold nothing; repeated
    rows of ``documents`` give repeated rows; repeated items count once.  Items are
    broadcast in blocks of ``BLOCK_ITEMS``, each of which a shard is searched for
    in turn: documents are read once.  Empty tables give no rows.
    """
    spark = documents.sparkSession
    texts = spread(documents.select("doc_id", "text").where(F.length("text") > 0))
    rows = items.select("item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    blocks = max(1, -(-rows.count() // BLOCK_ITEMS))
    models = []
    for number in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        models.append(spark.sparkContext.broadcast(pickle.dumps(sorted((r["item_id"], r["text"]) for r in own))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list = []
        parts: list = []
        total = 0

        def shard() -> Iterator[pa.RecordBatch]:
            for model in models:
                passages = _worker_passages(model.value)
                # With one block the words are numbered as they come, else the texts are kept for every block.
                got = parts if len(models) == 1 else [passages.ids(p) for p in parts]
                found = search_shard(passages, np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])) if got else []
                if found:
                    cols = list(zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array([docs[k] for k in cols[0]], pa.int64()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "item_id", "from_word", "to_word"])

        for batch in batches:
            for part in pieces(batch, (1,)):
                own = part.column(1).to_pylist()
                if len(models) == 1:
                    ids, counts = _worker_passages(models[0].value).ids(own)
                    parts.append((ids.astype(np.int32), counts))
                    total += len(ids)
                else:
                    parts.append(own)
                    total += sum(map(len, own)) // 6
                docs += part.column(0).to_pylist()
                if total >= SHARD_WORDS:
                    yield from shard()
                    docs, parts, total = [], [], 0
        yield from shard()

    return texts.mapInArrow(run, "doc_id bigint, item_id bigint, from_word bigint, to_word bigint")


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id``: the documents that hold a part of an item's passage, each pair once."""
    return spans(documents, items).select("doc_id", "item_id").distinct()


def removal_spans(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, from_word, to_word, items``: overlapping or touching spans of a document merged into one."""
    from pyspark.sql import Window

    s = spans(documents, items)
    w = Window.partitionBy("doc_id").orderBy("from_word", "to_word")
    reach = F.max("to_word").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = s.withColumn("fresh", F.when(F.col("from_word") <= reach, 0).otherwise(1))
    island = fresh.withColumn("island", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy("doc_id", "island").agg(F.min("from_word").alias("from_word"), F.max("to_word").alias("to_word"), F.array_sort(F.collect_set("item_id")).alias("items")).drop("island")
