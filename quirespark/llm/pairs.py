"""Problem 2: defective answers among prompt and response pairs.

The languages of a prompt and of its response are compared by the posteriors of a
character n-gram naive Bayes: the language asked for and that of the prompt are
what a response is expected in beforehand, and each sentence of it is scored
without the words that it shares with the prompt (names, codes).  A response
breaks off where an interpolated n-gram model of ends, counted over all
responses, finds that texts seldom end on its last characters and that such an
ending seldom goes with that of its prompt; a response that ends well but has
fewer sentences than its prompt, or far less text, lacks its end as well.  Empty
responses, refusals and copies show in no posterior and are decided by words.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .batches import pieces
from .ngrams import CharBayes, clean_lines, labelled_sample

TARGET = "ru"
#: Slots of the table of n-grams of each order, and the longest n-gram, of the model of ends.
SLOTS = 1 << 17
ORDER = 4
#: What a response's language is taken to be beforehand: the one asked for, the prompt's, any.
EXPECTED = (0.5, 0.35, 0.15)
#: Below these an ending is not one of a complete text.
LEAST_END = 0.01
LEAST_PAIR = 0.015
#: Above this an ending is so usual after its source that its letters do not matter.
USUAL_PAIR = 0.3
#: Letters of an answer a letter of its source, below which content is missing.
LEAST_RATIO = 0.5
#: Share of the source's words that a copy holds.
COPY_SHARE = 0.9

# Stand-ins for "nothing", and what a refusal is made of.
NOTHING = frozenset(
    "null none nil nan undefined n/a na n.a. empty blank missing tbd todo tba translation <empty> <null> <none> [empty] [blank] [] {} () \"\" '' ru_text "
    "нет пусто пустая отсутствует неизвестно перевод".split()
) | {"no translation", "нет перевода", "перевод отсутствует", "нет текста", "нет данных"}
_REFUSE = regex.compile(
    r"\bне (?:могу|можем|смогу|буду|будем|вправе|имею|имеем|в состоянии|в силах|разреш\w+|способ\w+|удалось|получится)\b|\bневозмож\w+|\bнельзя\b|\bотказ\w+|\bвынужден\w*|\bзапрещ\w+"
    r"|\bunable\b|\bcannot\b|\bcan['’]?t\b|\bcan not\b|\bwon['’]?t\b|\bdeclin\w+|\brefus\w+|\bnot (?:able|allowed|permitted|possible)\b"
)
_ABOUT = regex.compile(
    r"\bперев(?:од|ест|ож)\w*|\bзапрос\w*|\bтекст\w*|\bфрагмент\w*|\bотрыв\w+|\bсодержан\w+|\bконтент\w*|\bязыковая модель|\bассистент\w*|\bпросьб\w+"
    r"|\btranslat\w+|\brequest\w*|\bcontent\b|\bpassages?\b|\btexts?\b|\bassistant\b|\blanguage model\b|\bexcerpt\b|\bhelp with\b"
)
_CODE = regex.compile(r"\{[^{}]*\}|<[^<>]*>|\[[^\[\]]*\]|https?://\S+|&\w+;")
_LETTERS = regex.compile(r"\p{L}+")
_ALNUM = regex.compile(r"[\p{L}\p{N}]")
_SENTENCE = regex.compile(r"(?<=[.!?;…])[\s»”\"')]+")
_STOP = regex.compile(r"[.!?;…]+[»”\"')\]]*(?=\s|$)")
_DIGITS = regex.compile(r"\d+")


def ending(text: str) -> str:
    """Kind of the last visible character of a text."""
    for c in reversed(text):
        if not c.isspace():
            return "a" if c.isalpha() else "0" if c.isdigit() else c
    return ""


def _slots(codes: list[np.ndarray]) -> np.ndarray:
    """Slot of the n-gram of characters whose codes stand in the arrays, one after the other."""
    mixed = np.zeros(len(codes[0]), np.uint64)
    for c in codes:
        mixed = (mixed ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(SLOTS)).astype(np.int64)


def count_ends(answers: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often the n-grams of each slot occur in texts and end them, for orders 1 to ``ORDER``."""
    seen, ends = np.zeros((ORDER, SLOTS), np.int64), np.zeros((ORDER, SLOTS), np.int64)
    texts = [t for t in (a.rstrip() for a in answers) if t]
    if not texts:
        return seen, ends
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    stops = np.cumsum(lengths)
    place = np.arange(len(codes)) - np.repeat(stops - lengths, lengths)
    for n in range(1, ORDER + 1):
        at = np.flatnonzero(place >= n - 1)
        slot = _slots([codes[at - n + 1 + k] for k in range(n)])
        seen[n - 1] += np.bincount(slot, minlength=SLOTS)
        last = np.zeros(len(codes), bool)
        last[stops - 1] = True
        ends[n - 1] += np.bincount(slot[last[at]], minlength=SLOTS)
    return seen, ends


class Ends:
    """How likely the last characters of an answer end a text, and how endings of source and answer go together."""

    def __init__(self, seen: np.ndarray, ends: np.ndarray, pairs: dict[tuple[str, str], int]) -> None:
        self.seen, self.ends, self.pairs = seen, ends, pairs
        self.base = float(ends[0].sum() / max(1, seen[0].sum()))
        self.heads: Counter = Counter()
        for (s, _), n in pairs.items():
            self.heads[s] += n

    @classmethod
    def of(cls, sources: list[str], answers: list[str]) -> "Ends":
        """The model of texts at hand."""
        return cls(*count_ends(answers), Counter((ending(s), ending(a)) for s, a in zip(sources, answers) if a.rstrip()))

    def likelihoods(self, answers: list[str]) -> np.ndarray:
        """P(text ends here | last characters), one to ``ORDER`` of them, interpolated."""
        texts = [a.rstrip() for a in answers]
        p = np.full(len(texts), self.base)
        for n in range(1, ORDER + 1):
            at = np.flatnonzero([len(t) >= n for t in texts])
            if not len(at):
                break
            codes = np.frombuffer("".join(texts[k][-n:] for k in at).encode("utf-32-le", "replace"), np.uint32).reshape(-1, n)
            slot = _slots([codes[:, k] for k in range(n)])
            # The answer itself is one of those counted: one count less.
            seen, ends = np.maximum(0, self.seen[n - 1][slot] - 1), np.maximum(0, self.ends[n - 1][slot] - 1)
            p[at] = (ends + 8 * p[at]) / (seen + 8)
        return p

    def goes_with(self, source: str, answer: str) -> float:
        """Share of sources with such an ending whose answers end like this one."""
        s = ending(source)
        return (self.pairs.get((s, ending(answer)), 0) + 0.5) / (self.heads[s] + 10) if self.heads[s] >= 20 else 1.0


class Judge:
    """Defect of an answer, or None."""

    def __init__(self, bayes: CharBayes | None, ends: Ends) -> None:
        self.bayes, self.ends = bayes, ends

    @staticmethod
    def is_empty(source: str, answer: str | None) -> bool:
        if answer is None:
            return True
        bare = " ".join(regex.sub(r"[\p{C}\p{Z}]+", " ", answer).split())
        if not _ALNUM.search(bare):
            return bare != " ".join(source.split()) or not bare
        low = bare.lower().strip(" .!-–—_*")
        if low in NOTHING or regex.fullmatch(r"[<\[({]+/?\s*[\w -]{0,24}\s*/?[>\])}]+", low):
            return low != source.lower().strip(" .!-–—_*")
        return False

    @staticmethod
    def is_refusal(source: str, answer: str) -> bool:
        low = answer.lower()
        if not (_REFUSE.search(low) and _ABOUT.search(low)):
            return False
        numbers = set(_DIGITS.findall(source))
        return not (numbers and numbers <= set(_DIGITS.findall(answer)))

    @staticmethod
    def is_copy(source: str, answer: str) -> bool:
        s, a = [w.lower() for w in _LETTERS.findall(source)], [w.lower() for w in _LETTERS.findall(answer)]
        if not s:
            return False
        joined, within = "".join(s), "".join(a)
        if joined in within and len(within) - len(joined) <= max(24, len(joined) // 5):
            return True
        shared = sum((Counter(s) & Counter(a)).values())
        return shared >= COPY_SHARE * len(s) and len(a) <= 1.3 * len(s) + 3 and shared >= 0.7 * len(a)

    def foreign(self, sources: list[str], answers: list[str]) -> list[bool]:
        """True where most letters of a response, shared words aside, are in a language other than the one asked for.

        The posterior of each sentence starts from what the comparison with its
        prompt makes likely: the language asked for, the prompt's own, or any.
        """
        if self.bayes is None or TARGET not in self.bayes.labels:
            return [False] * len(answers)
        parts, owner, size = [], [], []
        for k, (source, answer) in enumerate(zip(sources, answers)):
            known = {w.lower() for w in _LETTERS.findall(source)}
            for sentence in _SENTENCE.split(answer):
                own = [w for w in _LETTERS.findall(sentence) if w.lower() not in known]
                n = sum(map(len, own))
                if n >= 4:
                    parts.append(" ".join(own))
                    owner.append(k)
                    size.append(n)
        if not parts:
            return [False] * len(answers)
        at = sorted(set(owner))
        row = {k: r for r, k in enumerate(at)}
        prompt = self.bayes.posteriors([sources[k] for k in at])
        asked, same, any_ = EXPECTED
        before = same * prompt + any_ / prompt.shape[1]
        ru = self.bayes.labels.index(TARGET)
        before[:, ru] += asked
        s = self.bayes.scores(parts) + np.log(before[[row[k] for k in owner]])
        e = np.exp(s - s.max(axis=1, keepdims=True))
        post = e[:, ru] / e.sum(axis=1)
        weight = np.array(size, float)
        other = np.bincount(owner, weight * (post < 0.5), len(answers))
        total = np.bincount(owner, weight, len(answers))
        return (other > 0.5 * np.maximum(total, 1)).tolist()

    def is_truncated(self, source: str, answer: str, end: float) -> bool:
        """``end`` is the likelihood of the answer's last characters as an end."""
        usual = self.ends.goes_with(source, answer)
        if usual < LEAST_PAIR or usual < USUAL_PAIR and end < LEAST_END:
            return True
        # It ends well; whether the end is that of its prompt shows in what is missing.
        s, a = sum(map(len, _LETTERS.findall(source))), sum(map(len, _LETTERS.findall(answer)))
        if s >= 12 and a < LEAST_RATIO * s:
            return True
        return a < 1.1 * s and len(_STOP.findall(answer)) < len(_STOP.findall(source))

    def defects(self, sources: list[str], answers: list[str | None]) -> list[str | None]:
        given = [a or "" for a in answers]
        foreign, ends = self.foreign(sources, given), self.ends.likelihoods(given)
        out: list[str | None] = []
        for source, answer, other, end in zip(sources, answers, foreign, ends.tolist()):
            wordless = not _LETTERS.search(_CODE.sub(" ", source))
            if self.is_empty(source, answer):
                out.append("empty")
            elif self.is_refusal(source, answer):
                out.append("refusal")
            elif wordless:
                out.append("language" if other else None)
            elif self.is_copy(source, answer):
                out.append("copy")
            elif other:
                out.append("language")
            elif self.is_truncated(source, answer, end):
                out.append("truncated")
            else:
                out.append(None)
        return out


def pairs(units: DataFrame, answers: DataFrame) -> DataFrame:
    """``unit_id, inline_id, attempt, source, answer`` of each answer to a node with text; repeated answers may repeat."""
    nodes = (
        units.select("unit_id", F.explode("text_nodes").alias("n"))
        .select("unit_id", F.col("n.inline_id").alias("inline_id"), F.col("n.source_text").alias("source"))
        .where(F.length("source") > 0)
        .groupBy("unit_id", "inline_id")
        .agg(F.max("source").alias("source"))
    )
    return answers.select("unit_id", "inline_id", "attempt", F.col("ru_text").alias("answer")).join(nodes, ["unit_id", "inline_id"]).select("unit_id", "inline_id", "attempt", "source", "answer")


def end_counts(joined: DataFrame) -> DataFrame:
    """``n, slot, seen, ends`` over all answers of ``joined``: at most ``ORDER * SLOTS`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, ends = np.zeros((ORDER, SLOTS), np.int64), np.zeros((ORDER, SLOTS), np.int64)
        for batch in batches:
            for part in pieces(batch, (0,)):
                a, b = count_ends([t for t in part.column(0).to_pylist() if t])
                seen += a
                ends += b
        n, slot = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(slot, pa.int32()), pa.array(seen[n, slot]), pa.array(ends[n, slot])], ["n", "slot", "seen", "ends"])

    return joined.select("answer").mapInArrow(run, "n int, slot int, seen bigint, ends bigint").groupBy("n", "slot").agg(F.sum("seen").alias("seen"), F.sum("ends").alias("ends"))


def _ending(text: Column) -> Column:
    """:func:`ending` of a text, but any other sign as it is."""
    last = F.regexp_extract(text, r"(\S)\s*$", 1)
    return F.when(last.rlike(r"^\p{L}$"), "a").when(last.rlike(r"^\p{Nd}$"), "0").otherwise(last)


def fit_judge(joined: DataFrame, documents: DataFrame) -> Judge:
    """A judge with the ends of all answers in ``joined`` and languages of a bounded sample of labelled documents.

    The driver receives the tables of ends (``ORDER * SLOTS`` counts) and the
    kinds of endings, of which there are no more than pairs of characters.
    """
    seen, ends = np.zeros((ORDER, SLOTS), np.int64), np.zeros((ORDER, SLOTS), np.int64)
    got = end_counts(joined).toArrow()
    n, slot = got.column("n").to_numpy(), got.column("slot").to_numpy()
    seen[n, slot], ends[n, slot] = got.column("seen").to_numpy(), got.column("ends").to_numpy()
    kinds = joined.where(F.trim("answer") != "").groupBy(_ending(F.col("source")).alias("s"), _ending(F.col("answer")).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    texts, labels = labelled_sample(documents)
    lines, owner, _ = clean_lines(texts, labels) if texts else ([], [], [])
    return Judge(CharBayes.fit(lines, owner) if lines else None, Ends(seen, ends, {(r["s"], r["a"]): r["n"] for r in kinds.collect()}))


_JUDGES: dict[int, Judge] = {}


def _worker_judge(raw: bytes) -> Judge:
    key = hash(raw)
    if key not in _JUDGES:
        _JUDGES.clear()
        _JUDGES[key] = pickle.loads(raw)
    return _JUDGES[key]


def found(units: DataFrame, answers: DataFrame, documents: DataFrame) -> DataFrame:
    """``unit_id, inline_id, attempt, defect`` of each defective answer, each attempt judged alone.

    ``defect`` is the first that applies of ``empty``, ``refusal``, ``copy``,
    ``language`` and ``truncated``.  Answers to unknown nodes and to nodes whose
    source is NULL or empty are left out; repeated rows come out once; a source
    without words may stand unchanged.  ``documents`` only serves to learn what
    the languages look like.  Empty tables give no rows.
    """
    # The join is read three times, twice for the counts of the model: it is written once.
    ensure_checkpoint_dir(answers.sparkSession)
    joined = pairs(units, answers).checkpoint()
    judge = joined.sparkSession.sparkContext.broadcast(pickle.dumps(fit_judge(joined, documents)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _worker_judge(judge.value)
        for batch in batches:
            for part in pieces(batch, (3, 4)):
                got = own.defects(part.column(3).to_pylist(), part.column(4).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(got, pa.string())], ["unit_id", "inline_id", "attempt", "defect"])

    judged = joined.select("unit_id", "inline_id", "attempt", "source", "answer").mapInArrow(run, "unit_id string, inline_id string, attempt int, defect string")
    return judged.where(F.col("defect").isNotNull()).distinct()
