"""Character n-gram naive Bayes over hashed trigrams, fitted on a bounded sample."""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("de", "en", "es", "fr", "ru", "uk")
BUCKETS = 1 << 16
#: Labelled documents of a language that a classifier is fitted on, and characters of each.
SAMPLE_DOCUMENTS = 250
SAMPLE_CHARS = 3000

_OTHER = regex.compile(r"[^\p{L}]+")


def letters_only(text: str) -> str:
    """Lower case, anything but letters turned into single spaces."""
    return _OTHER.sub(" ", text.lower())


def trigram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every trigram of all texts, number of trigrams of each text)."""
    padded = [f"  {letters_only(t).strip()}  " for t in texts]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    code = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32)
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    code = code.astype(np.uint64)
    mixed = (code[:-2] * np.uint64(0x9E3779B1) ^ code[1:-1] * np.uint64(0x85EBCA6B) ^ code[2:] * np.uint64(0xC2B2AE35)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(48)).astype(np.int64)
    ends = np.cumsum(lengths)
    keep = np.ones(len(bucket), bool)
    for off in (2, 1):
        border = ends[:-1] - off
        keep[border[border < len(keep)]] = False
    return bucket[keep], lengths - 2


class CharBayes:
    """log P(trigram | language) as a table of ``BUCKETS`` rows; its size does not depend on the sample."""

    def __init__(self, labels: tuple[str, ...], table: np.ndarray) -> None:
        self.labels, self.table = labels, table

    @classmethod
    def fit(cls, texts: list[str], labels: list[str]) -> "CharBayes":
        names = tuple(sorted(set(labels)))
        table = np.zeros((BUCKETS, len(names)), np.float32)
        for k, name in enumerate(names):
            bucket, _ = trigram_buckets([t for t, x in zip(texts, labels) if x == name])
            counts = np.bincount(bucket, minlength=BUCKETS) + 0.1
            table[:, k] = np.log(counts / counts.sum())
        return cls(names, table)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Sum of the log likelihoods of each text under each language."""
        out = np.zeros((len(texts), len(self.labels)), np.float32)
        if not texts:
            return out
        bucket, counts = trigram_buckets(texts)
        heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
        if len(bucket):
            some = counts > 0
            out[some] = np.add.reduceat(self.table[bucket], heads[some], axis=0)
        return out

    def posteriors(self, texts: list[str]) -> np.ndarray:
        s = self.scores(texts)
        e = np.exp(s - s.max(axis=1, keepdims=True)) if len(texts) else s
        return e / e.sum(axis=1, keepdims=True) if len(texts) else e


def label_code(column) -> "F.Column":
    """A language label without case, blanks and region; NULL stays NULL."""
    return F.regexp_extract(F.lower(F.trim(column)), r"^([a-z?]*)", 1)


def labelled_sample(documents: DataFrame, per_language: int = SAMPLE_DOCUMENTS, chars: int = SAMPLE_CHARS) -> tuple[list[str], list[str]]:
    """Texts (of more than twenty characters) and labels of at most ``per_language`` documents of each known language.

    Documents are counted by label first, so that each language is sampled at a
    rate of its own and a rare one is taken whole.  They are chosen by a hash of
    their id; only this bounded sample (``6 * per_language`` texts of ``chars``
    characters) reaches the driver.
    """
    code = label_code(F.col("lang"))
    usable = documents.select("doc_id", code.alias("code"), "text").where(F.col("code").isin(*LANGUAGES) & (F.length("text") > 20))
    counts = {r["code"]: r["n"] for r in usable.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    order = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 1)
    # Twice the number wanted, so that chance leaves no language short.
    share = {c: min(1.0, (2.0 * per_language + 50) / n) for c, n in counts.items()}
    fine = F.lit(False)
    for c, x in share.items():
        fine = fine | ((F.col("code") == c) & (order <= min(int(x * 2**63), 2**63 - 1)))
    some = usable.where(fine).select("code", order.alias("order"), F.substring("text", 1, chars).alias("text"))
    picked = some.groupBy("code").agg(F.slice(F.sort_array(F.collect_list(F.struct("order", "text"))), 1, per_language).alias("rows"))
    texts, labels = [], []
    for row in sorted(picked.collect(), key=lambda r: r["code"]):
        texts += [r["text"] for r in row["rows"]]
        labels += [row["code"]] * len(row["rows"])
    return texts, labels


def clean_lines(texts: list[str], labels: list[str], rounds: int = 2) -> tuple[list[str], list[str], list[list[tuple[str, str]]]]:
    """Lines of a sample with the language that the sample as a whole says they have.

    Labels are wrong in places, so the classifier is refitted on the lines that
    it assigns itself.  Also returns the lines of each text in order.
    """
    lines = [[x for x in t.split("\n") if len(letters_only(x)) > 15] for t in texts]
    flat = [x for ls in lines for x in ls]
    owner = [lab for ls, lab in zip(lines, labels) for _ in ls]
    for _ in range(rounds + 1):
        model = CharBayes.fit(flat, owner)
        scores = model.scores(flat)
        owner = [model.labels[k] for k in scores.argmax(axis=1)]
    at, by_text = 0, []
    for ls in lines:
        by_text.append(list(zip(ls, owner[at : at + len(ls)])))
        at += len(ls)
    return flat, owner, by_text
