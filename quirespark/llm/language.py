"""Problem 9: the language of documents and of the lines within them.

A linear-chain conditional random field labels the words of a document.  Each
word has affix, n-gram and lexicon (whole word) features, hashed into a table of
fixed size; the transitions are learned from sequences in which lines of other
languages stand between lines of one language.  Forward-backward gives the
posterior of each word; lines and documents add the posteriors of their words,
weighted by letters.  Scores of a word are computed once a worker, and the
documents of a batch run through the chain together.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from itertools import chain as _chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .batches import pieces
from .ngrams import clean_lines, label_code, labelled_sample

chain_of = _chain.from_iterable

FEATURES = 1 << 17
MEMO_WORDS = 400_000
#: Words (padding included) that run through the chain together.
CELLS = 120_000
#: A foreign line has at least so many words and letters, one of the words in small letters (names and terms have none).
LEAST_WORDS = 4
LEAST_LETTERS = 15
LEAST_SHARE = 0.6

_LETTER = regex.compile(r"\p{L}")
_EDGE = regex.compile(r"^[^\p{L}]+|[^\p{L}]+$")


def word_of(chunk: str) -> str:
    """A chunk between white space without what surrounds its letters, in lower case."""
    return _EDGE.sub("", chunk).lower()


def features(word: str) -> list[int]:
    """Hashed features of a word: affixes, n-grams and the word as a lexicon entry."""
    w = f"<{word}>"
    names = ["w" + w]
    for n in (1, 2, 3):
        names += [f"p{word[:n]}", f"s{word[-n:]}"]
    names += [w[i : i + 3] for i in range(len(w) - 2)] + [w[i : i + 2] for i in range(len(w) - 1)]
    return [zlib.crc32(x.encode("utf-8", "replace")) & (FEATURES - 1) for x in names]


class Chain:
    """Emission weights by feature, transitions and start of the field."""

    def __init__(self, labels: tuple[str, ...], weights: np.ndarray, moves: np.ndarray) -> None:
        self.labels, self.weights, self.moves = labels, weights, moves
        self._reset()

    def __getstate__(self) -> dict:
        return {"labels": self.labels, "weights": self.weights, "moves": self.moves}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["labels"], state["weights"], state["moves"])

    def _reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.scores = np.ones((1024, len(self.labels)), np.float32)
        self.letters = np.zeros(1024, np.int32)
        self.plain = np.zeros(1024, bool)

    def index(self, chunks: list[str]) -> np.ndarray:
        """Row of each chunk in ``scores``; chunks without letters have ``letters`` 0."""
        memo = self.memo
        new = set(chunks).difference(memo)
        if new:
            if len(memo) + len(new) > MEMO_WORDS and memo:
                self._reset()
                memo, new = self.memo, set(chunks)
            while len(memo) + len(new) > len(self.letters):
                self.scores = np.concatenate([self.scores, np.ones_like(self.scores)])
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
                self.plain = np.concatenate([self.plain, np.zeros_like(self.plain)])
            for chunk in new:
                k = memo[chunk] = len(memo)
                self.letters[k] = n = len(_LETTER.findall(chunk))
                if n:
                    word = word_of(chunk)
                    raw = self.weights[features(word)].sum(axis=0)
                    self.scores[k] = np.maximum(np.exp(raw - raw.max()), 1e-6)
                    self.plain[k] = not _EDGE.sub("", chunk)[0].isupper()
        return np.fromiter(map(memo.__getitem__, chunks), np.int64, len(chunks))

    def posteriors(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Posterior of each label at each word; ``words`` are rows of ``scores``, text after text."""
        out = np.zeros((len(words), len(self.labels)), np.float32)
        heads = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        order = order[counts[order] > 0]
        step = np.exp(self.moves - self.moves.max()).astype(np.float32)
        at = 0
        while at < len(order):
            longest = int(counts[order[at]])
            own = order[at : at + max(1, CELLS // longest)]
            at += len(own)
            sizes = counts[own]
            column = np.repeat(np.arange(len(own)), sizes)
            row = np.arange(len(column)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            where = np.repeat(heads[own], sizes) + row
            grid = np.zeros((longest, len(own)), np.int64)
            grid[row, column] = words[where]
            out[where] = forward_backward(self.scores[grid], step, sizes)[row, column]
        out /= out @ np.ones((out.shape[1], 1), np.float32)
        return out


def forward_backward(likely: np.ndarray, step: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Posteriors, up to a factor a word, of ``likely`` (steps, sequences, labels) under transitions ``step``.

    What stands after the end of a sequence (``lengths``) has no influence on it.
    Messages are rescaled every fourth step, which single precision allows for.
    """
    one = np.ones((likely.shape[2], 1), np.float32)
    ahead = np.empty_like(likely)
    ahead[0] = a = likely[0]
    for t in range(1, len(likely)):
        a = a @ step
        a *= likely[t]
        if not t & 3:
            a /= a @ one
        ahead[t] = a
    ends = set((lengths - 1).tolist())
    b = np.ones_like(likely[0])
    back = step.T.copy()
    for t in range(len(likely) - 2, -1, -1):
        b = (b * likely[t + 1]) @ back
        if not t & 3:
            b /= b @ one
        if t in ends:
            b[lengths <= t + 1] = 1
        ahead[t] *= b
    return ahead


def fit_chain(texts: list[str], labels: list[str], length: int = 96, steps: int = 80, seed: int = 7) -> Chain | None:
    """A chain fitted by gradient ascent on sequences with known language of each word.

    Sequences are made of lines of one language with lines of others between
    them.  None where the sample has no line of any language.
    """
    if not texts:
        return None
    _, _, by_text = clean_lines(texts, labels)
    # The labels are those given; the classifier of single lines only says which of them to trust.
    trusted = [(line, lang) for lines, given in zip(by_text, labels) for line, lang in lines if lang == given]
    if not trusted:
        return None
    names = tuple(sorted({lang for _, lang in trusted}))
    L = len(names)
    by: list[list[list[str]]] = [[] for _ in names]
    for line, lang in trusted:
        words = [w for w in map(word_of, line.split()) if w]
        if words:
            by[names.index(lang)].append(words)
    feats: dict[str, list[int]] = {w: features(w) for w in {w for group in by for words in group for w in words}}
    seen = [[f for words in group for w in words for f in feats[w]] for group in by]
    counts = np.stack([np.bincount(np.array(x, np.int64), minlength=FEATURES) for x in seen], axis=1) + 0.05
    logs = np.log(counts / counts.sum(axis=0))
    weights = (0.25 * (logs - logs.mean(axis=1, keepdims=True))).astype(np.float32)
    moves = np.full((L, L), np.log(0.02 / max(1, L - 1)), np.float32)
    np.fill_diagonal(moves, np.log(0.98))
    if L == 1:
        return Chain(names, weights, moves)
    rng = np.random.default_rng(seed)
    square_w, square_m = np.full(weights.shape, 1e-2, np.float32), np.full(moves.shape, 1e-2, np.float32)
    filled = [k for k in range(L) if by[k]]
    for _ in range(steps):
        seqs, gold = [], []
        for _ in range(24):
            main = int(rng.choice(filled))
            ws, gs = [], []
            while len(ws) < length:
                k = int(rng.choice(filled)) if rng.random() < 0.25 else main
                line = by[k][int(rng.integers(len(by[k])))]
                ws += line
                gs += [k] * len(line)
            seqs.append(ws[:length])
            gold.append(gs[:length])
        g = np.array(gold).T
        flat = [feats[w] for t in range(length) for w in (s[t] for s in seqs)]
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        ids = np.concatenate(flat)
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        emit = np.add.reduceat(weights[ids], heads, axis=0).reshape(length, len(seqs), L)
        likely = np.maximum(np.exp(emit - emit.max(axis=2, keepdims=True)), 1e-6)
        step = np.exp(moves - moves.max())
        post = forward_backward(likely, step, np.full(len(seqs), length))
        post /= post.sum(axis=2, keepdims=True)
        error = -post
        error[np.arange(length)[:, None], np.arange(len(seqs))[None, :], g] += 1
        spread = np.repeat(error.reshape(-1, L), sizes, axis=0)
        grad = np.stack([np.bincount(ids, spread[:, k], FEATURES) for k in range(L)], axis=1).astype(np.float32)
        grad -= 1e-3 * weights
        square_w += grad**2
        weights += 0.05 * grad / np.sqrt(square_w)
        # Expected transitions by the posteriors of neighbours, observed by the labels.
        pair = post[:-1, :, :, None] * step[None, None] * post[1:, :, None, :]
        pair /= np.maximum(pair.sum(axis=(2, 3), keepdims=True), 1e-30)
        seen = np.zeros((L, L), np.float32)
        np.add.at(seen, (g[:-1].ravel(), g[1:].ravel()), 1)
        move = seen - pair.sum(axis=(0, 1))
        square_m += move**2
        moves += 0.05 * move / np.sqrt(square_m)
    return Chain(names, weights, moves)


def label_batch(chain: Chain, texts: list[str], spans: list | None = None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, float]]]:
    """Main language (or -1) and its share for each text, and (text, line, language, share) of lines in another.

    ``spans`` is filled with (text, line, first word, last word, language, share)
    of runs of words in another language than the text, words counted from 1
    within their line.
    """
    lines = [[line.split() for line in text.split("\n")] for text in texts]
    sizes = np.fromiter(map(len, chain_of(lines)), np.int64)
    chunks = list(chain_of(chain_of(lines)))
    main, share = np.full(len(texts), -1), np.zeros(len(texts))
    if not chunks:
        return main, share, []
    index = chain.index(chunks)
    place = np.arange(len(chunks)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    per_text = np.fromiter(map(len, lines), np.int64, len(lines))
    text_of_line = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(sizes)) - np.repeat(np.cumsum(per_text) - per_text, per_text) + 1
    line_of = np.repeat(np.arange(len(sizes)), sizes)
    has = chain.letters[index] > 0
    words, line_of, place = index[has], line_of[has], place[has]
    if not len(words):
        return main, share, []
    letters = chain.letters[words]
    post = chain.posteriors(words, np.bincount(text_of_line[line_of], minlength=len(texts)))
    heads = np.flatnonzero(np.concatenate([[True], line_of[1:] != line_of[:-1]]))
    used = line_of[heads]
    by_line = np.add.reduceat(post * letters[:, None], heads, axis=0)
    best, total = by_line.argmax(axis=1), by_line.sum(axis=1)
    text = text_of_line[used]
    labels = len(chain.labels)
    mine = np.bincount(text * labels + best, total, len(texts) * labels).reshape(-1, labels)
    some = mine.sum(axis=1) > 0
    main[some] = mine[some].argmax(axis=1)
    share[some] = mine[some].max(axis=1) / mine[some].sum(axis=1)
    small = np.add.reduceat(chain.plain[words], heads, dtype=np.int64)
    count = np.diff(np.concatenate([heads, [len(words)]]))
    size = np.add.reduceat(letters, heads)
    part = by_line[np.arange(len(best)), best] / total
    foreign = (best != main[text]) & (small > 0) & (count >= LEAST_WORDS) & (size >= LEAST_LETTERS) & (part >= LEAST_SHARE)
    at = np.flatnonzero(foreign)
    if spans is not None:
        top = post.argmax(axis=1)
        first = np.flatnonzero(np.concatenate([[True], (line_of[1:] != line_of[:-1]) | (top[1:] != top[:-1])]))
        number_of = np.diff(np.concatenate([first, [len(words)]]))
        lang, owner = top[first], text_of_line[line_of[first]]
        mass = np.add.reduceat(post[np.arange(len(top)), top] * letters, first)
        long = np.add.reduceat(letters, first)
        low = np.add.reduceat(chain.plain[words], first, dtype=np.int64)
        good = np.flatnonzero((lang != main[owner]) & (number_of >= LEAST_WORDS) & (long >= LEAST_LETTERS) & (low > 0) & (mass >= LEAST_SHARE * long))
        last = first + number_of - 1
        spans += zip(owner[good].tolist(), number[line_of[first[good]]].tolist(), place[first[good]].tolist(), place[last[good]].tolist(), lang[good].tolist(), (mass[good] / long[good]).tolist())
    return main, share, list(zip(text[at].tolist(), number[used[at]].tolist(), best[at].tolist(), part[at].tolist()))


_CHAINS: dict[int, Chain] = {}


def _worker_chain(raw: bytes) -> Chain:
    key = hash(raw)
    if key not in _CHAINS:
        _CHAINS.clear()
        _CHAINS[key] = pickle.loads(raw)
    return _CHAINS[key]


def languages(documents: DataFrame, chain: Chain | None = None) -> DataFrame:
    """``doc_id, label, line_no, lang, confidence``: line 0 is the document, others are its foreign lines.

    ``label`` is the given label without case, blanks and region.  Documents
    whose text is NULL or has no words give no rows, and an empty table or one
    without any labelled document gives none either.  Repeated rows give repeated rows.
    """
    spark = documents.sparkSession
    cols = "doc_id bigint, label string, line_no int, lang string, confidence double"
    if chain is None:
        chain = fit_chain(*labelled_sample(documents))
    if chain is None:
        return spark.createDataFrame([], cols)
    model = spark.sparkContext.broadcast(pickle.dumps(chain))
    source = spread(documents.where(F.length("text") > 0).select("doc_id", label_code(F.col("lang")).alias("label"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _worker_chain(model.value)
        for batch in batches:
            for part in pieces(batch, (2,)):
                ids, labels = part.column(0).to_pylist(), part.column(1).to_pylist()
                main, share, foreign = label_batch(own, part.column(2).to_pylist())
                rows = [(ids[k], labels[k], 0, own.labels[main[k]], float(share[k])) for k in np.flatnonzero(main >= 0).tolist()]
                rows += [(ids[k], labels[k], no, own.labels[lang], sure) for k, no, lang, sure in foreign]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.float64()))],
                        ["doc_id", "label", "line_no", "lang", "confidence"],
                    )

    return source.mapInArrow(run, cols)


def segments(documents: DataFrame, chain: Chain | None = None) -> DataFrame:
    """``doc_id, line_no, from_word, to_word, lang, confidence``: runs of words in another language than their document's.

    Words are counted from 1 between white space within a line; a run within a
    line is long enough by the measures of a foreign line.  Nulls and empty
    tables as in :func:`languages`.
    """
    spark = documents.sparkSession
    cols = "doc_id bigint, line_no int, from_word int, to_word int, lang string, confidence double"
    if chain is None:
        chain = fit_chain(*labelled_sample(documents))
    if chain is None:
        return spark.createDataFrame([], cols)
    model = spark.sparkContext.broadcast(pickle.dumps(chain))
    source = spread(documents.where(F.length("text") > 0).select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _worker_chain(model.value)
        for batch in batches:
            for part in pieces(batch, (1,)):
                ids, got = part.column(0).to_pylist(), []
                label_batch(own, part.column(1).to_pylist(), got)
                if got:
                    rows = [(ids[k], line, a, b, own.labels[lang], sure) for k, line, a, b, lang, sure in got]
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "line_no", "from_word", "to_word", "lang", "confidence"])

    return source.mapInArrow(run, cols)


def found(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no, lang``: documents with a missing or wrong label, and foreign lines."""
    rows = languages(documents)
    wrong = (F.col("line_no") > 0) | ~F.col("label").eqNullSafe(F.col("lang"))
    return rows.where(wrong).select("doc_id", "line_no", "lang").distinct()
