"""Problem 5: text that looks as usual but holds other characters.

The skeleton of a word is made by decomposing it, replacing every character by
the prototype of its look-alikes, and decomposing again.  The table of prototypes
is Unicode's own, read from the ICU library that Spark ships, with a few pairs
added.  All words of all texts are grouped by equal skeleton; a group knows the
commonest well-formed original in each alphabet.  A word that is written in
several alphabets, or in letters that another alphabet could have just as well
with no other word to tell, is looked up in its group and takes the original
there; where a group has no original, the prototypes supply one letter by letter.
"""

from __future__ import annotations

import math
import pickle
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

# Letters that look like a Latin letter, and that letter.
CYRILLIC = dict(zip("аеорсухѕіјԁһԛԝӏѵүԍАВЕКМНОРСТУХЅІЈԌԚԜѴҮӀ", "aeopcyxsijdhqwlvyGABEKMHOPCTYXSIJGQWVYI"))
GREEK = dict(zip("οαινκρυχτωϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "oaivkpuxtwcjABEZHIKMNOPTYXCJ"))
OTHER = dict(zip("ıɑɡɩʋօսհոց", "iagiuouhng"))
PROTOTYPE = {**CYRILLIC, **GREEK, **OTHER}
# The letters of Russian and Ukrainian that a Latin letter can stand for.
TO_CYRILLIC = dict(zip("aeopcyxikABEKMHOPCTYXI", "аеорсухікАВЕКМНОРСТУХІ"))
TO_GREEK = dict(zip("oaivkpuxABEZHIKMNOPTYX", "οαινκρυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"))
#: Cyrillic letters that neither Russian nor Ukrainian has: a word of look-alikes with one of them is Latin.
RARE = set("ѕјԁһԛԝӏѵүԍЅЈԌԚԜѴҮӀ")

#: Signs whose compatibility form differs although they are proper typography.
PROPER = set("…№™℠℡½¼¾")
_EMOJI = r"[\p{Extended_Pictographic}\p{Emoji_Modifier}\p{Regional_Indicator}♀♂⚕⚖✈❤️⃣]"
_KEPT = regex.compile(rf"(?<={_EMOJI})‍(?={_EMOJI})|(?<=[\p{{Extended_Pictographic}}#*0-9♀♂])[︎️]")
_HIDDEN = regex.compile(r"[\p{Cf}͏ᅟᅠ឴឵᠋-᠎ㅤﾠ︀-️]")
_SPACES = regex.compile(r"[\p{Zs}  --[ ]]", regex.V1)
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_SCRIPT = regex.compile(r"(\p{Latin})|(\p{Cyrillic})|(\p{Greek})|(\p{Armenian})")
#: Nothing to do where a text has only these and the letters of one alphabet.
_PLAIN = regex.compile(r"[\n\r\t -~¡-¬®-ÿĀ-ıĴ-ňŊ-ž‐-‟•…‰′-›№™€−×ЁА-яёІіЇїЄєҐґ]*+")
_LATIN = regex.compile(r"[A-Za-z]")
_CYRILLIC = regex.compile(r"[Ѐ-ӿ]")


def _folded(char: str) -> str:
    """What a full-width form, joined letter or letter-like sign stands for; else the character."""
    if char in PROPER or char < "Ĳ":
        return char
    kind = unicodedata.decomposition(char)
    if not kind:
        return char
    tag = kind.split(" ", 1)[0] if kind[0] == "<" else ""
    if tag in ("<wide>", "<narrow>", "<font>"):
        return unicodedata.normalize("NFKC", char)
    if tag in ("<compat>", "<circle>"):
        whole = unicodedata.normalize("NFKC", char)
        return whole if whole.isalpha() else char
    return char


_FOLD: dict[str, str] = {}


def fold(text: str) -> str:
    """Composed text without invisible characters, odd spaces, wide forms and ligatures."""
    out, at = [], 0
    for m in _KEPT.finditer(text):
        out += [_HIDDEN.sub("", text[at : m.start()]), m.group()]
        at = m.end()
    out.append(_HIDDEN.sub("", text[at:]))
    text = _SPACES.sub(" ", "".join(out))
    if not text.isascii():
        parts = []
        for c in text:
            got = _FOLD.get(c)
            if got is None:
                got = _FOLD[c] = _folded(c)
            parts.append(got)
        text = unicodedata.normalize("NFC", "".join(parts))
    return text


#: Alphabets that a word can be brought to; X is any other that has look-alikes of them.
TARGETS = "LCG"


def script(char: str) -> str:
    m = _SCRIPT.match(char)
    return "LCGA"[m.lastindex - 1] if m else ""


class Prototypes:
    """What each character looks like, and which letters of an alphabet look like it."""

    def __init__(self, table: dict[str, str] | None = None) -> None:
        self.table = dict(table or {})
        for c, look in (*PROTOTYPE.items(), *((c, k) for k, c in TO_CYRILLIC.items()), *((c, k) for k, c in TO_GREEK.items())):
            self.table[c] = self.table.get(look, look)
        # The letter of an alphabet for a prototype: the pairs of usual letters first, then any letter that Unicode holds to look alike.
        self.stand: dict[str, dict[str, str]] = {"L": dict(PROTOTYPE), "C": {}, "G": {}}
        for target, pairs in (("C", TO_CYRILLIC), ("G", TO_GREEK)):
            self.stand[target].update(pairs)
            self.stand[target].update({c: pairs[k] for c, k in PROTOTYPE.items() if k in pairs and script(c) != target})
        for c, look in self.table.items():
            if len(c) == 1 and len(look) == 1 and script(c) != "L" and look.isascii() and look.isalpha() and c.isalpha() and c.isupper() == look.isupper():
                for target, pairs in (("L", {look: look}), ("C", TO_CYRILLIC), ("G", TO_GREEK)):
                    if look in pairs and script(c) != target:
                        self.stand[target].setdefault(c, pairs[look])
        self._kinds: dict[str, str] = {}

    def __getstate__(self) -> dict[str, str]:
        return self.table

    def __setstate__(self, table: dict[str, str]) -> None:
        self.__init__(table)

    @classmethod
    def of(cls, spark: SparkSession) -> "Prototypes":
        """Unicode's table of look-alikes, from the skeletons of all characters in one call of the library."""
        mark = "\ue000"
        chars = [c for c in map(chr, [*range(0x21, 0x7F), *range(0xA0, 0xD800), *range(0xF900, 0x30000)]) if unicodedata.category(c)[0] in "LMNSP" and not 0x3400 <= ord(c) < 0xA000 and not 0xAC00 <= ord(c) < 0xD7A4 and not 0x20000 <= ord(c)]
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        looks = checker.getSkeleton(0, mark.join(chars)).split(mark)
        if len(looks) != len(chars):
            raise ValueError("the library's skeletons do not line up with the characters")
        return cls({c: unicodedata.normalize("NFD", look) for c, look in zip(chars, looks) if look != unicodedata.normalize("NFD", c)})

    def skeleton(self, text: str) -> str:
        """Equal for texts that look alike: decompose, replace by prototypes, decompose again."""
        down = unicodedata.normalize("NFD", fold(text))
        return unicodedata.normalize("NFD", "".join(self.table.get(c, c) for c in down))

    def kind(self, char: str) -> str:
        """Alphabet of a letter: L, C, G, A (Armenian), X for others that look like one of these, or nothing."""
        got = self._kinds.get(char)
        if got is None:
            got = script(char)
            if not got and char.isalpha() and any(char in self.stand[t] for t in TARGETS):
                got = "X"
            self._kinds[char] = got
        return got

    def kinds(self, word: str) -> Counter:
        return Counter(s for s in map(self.kind, word) if s)

    def stand_in(self, word: str, target: str) -> str | None:
        """``word`` in the alphabet ``target``, or None where a letter has no counterpart there."""
        table = self.stand.get(target, {})
        out = []
        for c in word:
            s = self.kind(c)
            if s in ("", target):
                out.append(c)
                continue
            base, *marks = unicodedata.normalize("NFD", c)
            got = base if self.kind(base) == target else table.get(base)
            if got is None or script(got) != target:
                return None
            out.append(unicodedata.normalize("NFC", got + "".join(marks)))
        return "".join(out)

    def free(self, word: str) -> bool:
        """True where every letter could be one of another alphabet."""
        own = self.kinds(word)
        return len(own) == 1 and any(self.stand_in(word, t) is not None for t in TARGETS if t not in own)

    def well_formed(self, word: str) -> str:
        """The alphabet of a word that needs no change by itself, else nothing."""
        own = self.kinds(word)
        if len(own) != 1 or fold(word) != word:
            return ""
        kind = next(iter(own))
        return "" if kind not in TARGETS or kind == "C" and RARE.intersection(word) and self.stand_in(word, "L") else kind

    def open_words(self, text: str) -> list[dict]:
        """The words of a folded text that its other words do not settle.

        Each has ``at`` and ``word``, the alphabets it may be brought to in order
        (``order``), and the ``run`` of neighbours that are settled together.  A
        word of several alphabets is a run of its own (``must``); so is a single
        word all of whose neighbours are of another alphabet.
        """
        words = list(_WORD.finditer(text))
        kinds = [self.kinds(m.group()) for m in words]
        out: list[dict] = []
        settled = list(kinds)
        for k, (m, kind) in enumerate(zip(words, kinds)):
            if len(kind) > 1:
                word = m.group()
                beside = Counter(s for i in (k - 1, k + 1) if 0 <= i < len(words) and len(kinds[i]) == 1 for s in kinds[i])
                own = lambda t: sum(self.kind(c) == t and c not in PROTOTYPE and c not in TO_CYRILLIC for c in word)  # noqa: B023, E731
                order = sorted((t for t in kind if t in TARGETS), key=lambda t: (-own(t), t == "C" and bool(RARE.intersection(word)), -beside[t], -kind[t]))  # noqa: B023
                order = [t for t in order if self.stand_in(word, t) is not None]
                if order:
                    settled[k] = Counter(order[:1])
                    out.append({"at": m.start(), "word": word, "order": "".join(order), "run": -1 - k, "must": True})
        k = 0
        while k < len(words):
            end = k + 1
            if len(kinds[k]) == 1:
                own = next(iter(kinds[k]))
                while end < len(words) and len(kinds[end]) == 1 and own in kinds[end]:
                    end += 1
                out += self._run(words[k:end], own, k, [settled[i] for i in (k - 1, end) if 0 <= i < len(words)], [words[i].group() for i in (k - 1, end) if 0 <= i < len(words)])
            k = end
        return out

    def _run(self, run: list, own: str, number: int, near: list[Counter], beside: list[str]) -> list[dict]:
        """Words of one alphabet in a row, where none of them and no neighbour holds them to it."""
        if not all(self.free(m.group()) for m in run):
            return []
        # A single Greek letter is a symbol and says nothing about its neighbours.
        near = [n for n, w in zip(near, beside) if n and not (n["G"] and len(w) == 1)]
        if any(own in n for n in near):
            return []
        able = lambda t: all(self.stand_in(m.group(), t) is not None for m in run)
        around = [t for t in sorted({next(iter(n)) for n in near if len(n) == 1}) if t in TARGETS and able(t)]
        must = len(run) == 1 and bool(around)
        if not must and not near and own == "C" and any(RARE.intersection(m.group()) for m in run) and able("L"):
            around, must = ["L"], True
        order = around if must else [t for t in TARGETS if t != own and able(t)]
        return [{"at": m.start(), "word": m.group(), "order": "".join(order), "run": number, "must": must} for m in run] if order else []

    def settle(self, text: str, slots: list[dict]) -> str:
        """A folded text with its open words as their groups have them."""
        runs: dict[int, list[dict]] = {}
        for s in slots:
            runs.setdefault(s["run"], []).append(s)
        put: list[tuple[int, str, str]] = []
        for run in runs.values():
            if run[0]["must"]:
                target = run[0]["order"][0]
            else:
                own = next(iter(self.kinds(run[0]["word"])))
                gain = lambda t: sum(math.log(((s["group"][t] or ("", 0))[1] + 0.5) / ((s["group"].get(own) or ("", 0))[1] + 0.5)) for s in run)  # noqa: B023, E731
                known = [t for t in run[0]["order"] if all(s["group"][t] for s in run) and gain(t) > 0]
                if not known:
                    continue
                target = max(known, key=gain)
            put += [(s["at"], s["word"], self._original(s["word"], target, s["group"][target])) for s in run]
        out, at = [], 0
        for where, word, new in sorted(put):
            out += [text[at:where], new]
            at = where + len(word)
        return "".join([*out, text[at:]])

    def _original(self, word: str, target: str, group: tuple[str, int] | None) -> str:
        """The group's original where it has the word's own letters of the alphabet, else letter by letter."""
        built = self.stand_in(word, target) or word
        if group:
            same = len(group[0]) == len(word) and all(a == b for a, b in zip(word, group[0]) if self.kind(a) == target)
            if same and group[0].isupper() == built.isupper() and group[0][:1].isupper() == built[:1].isupper():
                return group[0]
        return built


#: The fixed pairs alone, for use without a session.
BASIC = Prototypes()


def skeleton(text: str) -> str:
    """:meth:`Prototypes.skeleton` by the fixed pairs alone."""
    return BASIC.skeleton(text)


def usual(text: str, prototypes: Prototypes = BASIC, groups: dict[str, dict] | None = None) -> str:
    """The one usual form of a text; ``groups`` holds by skeleton the originals of each alphabet and their counts."""
    if is_plain(text, prototypes):
        return text
    folded = fold(text)
    slots = [s | {"group": {t: (groups or {}).get(prototypes.skeleton(s["word"]), {}).get(t) for t in TARGETS}} for s in prototypes.open_words(folded)]
    return prototypes.settle(folded, slots)


# A Latin (Cyrillic) letter without look-alike among the letters of another alphabet holds a text of one alphabet to it.
_HOLDS_LATIN = regex.compile(r"[bfghqrtzQRFLUDdGSsjJWwNlV]")
_HOLDS_CYRILLIC = regex.compile(r"[бвгджзийлмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ]")


def is_plain(text: str, prototypes: Prototypes = BASIC) -> bool:
    """True where nothing can be replaced, found without looking at single words.

    The text has only usual signs and letters of one alphabet, one of which
    belongs to no other, or no letters at all.
    """
    if not text.isascii() and not _PLAIN.fullmatch(text):
        return False
    latin, cyrillic = _LATIN.search(text), _CYRILLIC.search(text)
    if latin and cyrillic:
        return False
    return bool(_HOLDS_LATIN.search(text)) if latin else not cyrillic or bool(_HOLDS_CYRILLIC.search(text))


def _records(primitives: DataFrame, inlines: DataFrame) -> DataFrame:
    a = primitives.select(F.lit("text_primitive").alias("record_kind"), "doc_id", F.col("primitive_id").alias("item_key"), "text")
    b = inlines.where(F.col("kind") == "glossary_ref").select(F.lit("glossary_ref").alias("record_kind"), "doc_id", F.col("inline_id").alias("item_key"), F.col("surface_form").alias("text"))
    return spread(a.unionByName(b).where(F.length("text") > 0))


#: Distinct chunks of text that are counted before they are taken apart.
CHUNKS = 300_000

_TABLES: dict[int, Prototypes] = {}


def _worker_prototypes(raw: bytes) -> Prototypes:
    key = hash(raw)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = pickle.loads(raw)
    return _TABLES[key]


def word_groups(records: DataFrame, prototypes) -> DataFrame:
    """``skeleton`` and, for each alphabet, the commonest well-formed original of the group and its number.

    Words are counted over all texts; ``prototypes`` is a broadcast of pickled ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker_prototypes(prototypes.value)
        chunks: Counter = Counter()

        def flush() -> pa.RecordBatch:
            counts: Counter = Counter()
            for chunk, n in chunks.items():
                for word in _WORD.findall(chunk):
                    counts[word] += n
            kept = [(table.skeleton(w), k, w, n) for w, n in counts.items() if (k := table.well_formed(w))]
            chunks.clear()
            cols = list(zip(*kept)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64()))], ["skeleton", "kind", "word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunks.update(text.split())
            if len(chunks) > CHUNKS:
                yield flush()
        yield flush()

    counted = records.select("text").mapInArrow(run, "skeleton string, kind string, word string, n bigint").groupBy("skeleton", "kind", "word").agg(F.sum("n").alias("n"))
    best = [F.max(F.when(F.col("kind") == t, F.struct("n", "word"))).alias(t) for t in TARGETS]
    return counted.groupBy("skeleton").agg(*best)


_SLOT = "struct<at: int, word: string, order: string, run: int, must: boolean>"


def usual_forms(primitives: DataFrame, inlines: DataFrame) -> DataFrame:
    """``record_kind, doc_id, item_key, text, usual, skeleton`` of the records that are to be changed.

    A record is a text of ``primitives`` or a surface form of a ``glossary_ref``
    in ``inlines``; NULL and empty texts are none.  Repeated rows come out once.
    Words that their text leaves open take the original of their group of equal
    skeletons.  Extra columns are not read; empty tables give no rows.
    """
    records = _records(primitives, inlines)
    spark = records.sparkSession
    prototypes = spark.sparkContext.broadcast(pickle.dumps(Prototypes.of(spark)))
    groups = word_groups(records, prototypes)
    names = ["record_kind", "doc_id", "item_key", "text"]
    cols = ", ".join(f"{c} string" for c in names)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker_prototypes(prototypes.value)
        slot = pa.struct([("at", pa.int32()), ("word", pa.string()), ("order", pa.string()), ("run", pa.int32()), ("must", pa.bool_()), ("skeleton", pa.string())])
        for batch in batches:
            keep, folded, slots = [], [], []
            for k, text in enumerate(batch.column(3).to_pylist()):
                if is_plain(text, table):
                    continue
                new = fold(text)
                own = [s | {"skeleton": table.skeleton(s["word"])} for s in table.open_words(new)]
                if own or new != text:
                    keep.append(k)
                    folded.append(new)
                    slots.append(own)
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(folded, pa.string()), pa.array(slots, pa.list_(slot))], [*names, "folded", "slots"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _worker_prototypes(prototypes.value)
        pair = lambda x: (x["word"], x["n"]) if x else None
        for batch in batches:
            new = []
            for folded, slots in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                new.append(table.settle(folded, [s | {"group": {t: pair(s[t]) for t in TARGETS}} for s in slots or [] if s["word"] is not None]))
            bare = [table.skeleton(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(new, pa.string()), pa.array(bare, pa.string())], [*names, "usual", "skeleton"])

    slot_type = _SLOT.replace("must: boolean", "must: boolean, skeleton: string")
    found = records.mapInArrow(look, f"{cols}, folded string, slots array<{slot_type}>").distinct()
    words = found.select(*names, "folded", F.explode_outer("slots").alias("s"))
    joined = words.join(groups.withColumnRenamed("skeleton", "__skeleton"), F.col("s.skeleton") == F.col("__skeleton"), "left")
    whole = joined.groupBy(*names, "folded").agg(F.collect_list(F.struct(F.col("s.at").alias("at"), F.col("s.word").alias("word"), F.col("s.order").alias("order"), F.col("s.run").alias("run"), F.col("s.must").alias("must"), *TARGETS)).alias("slots"))
    return whole.mapInArrow(settle, f"{cols}, usual string, skeleton string").where(F.col("usual") != F.col("text"))


def found(primitives: DataFrame, inlines: DataFrame) -> DataFrame:
    """``record_kind, doc_id, item_key`` of :func:`usual_forms`, each record once."""
    return usual_forms(primitives, inlines).select("record_kind", "doc_id", "item_key").distinct()
