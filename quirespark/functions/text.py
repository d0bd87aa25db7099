"""String normalisation and text predicates.

Everything is a built-in expression that stays inside generated code, but for
:func:`compose` and :func:`slug`, which need Unicode normal forms.
NULL in gives NULL out unless a function says otherwise.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the rules of the domain are made of.
BULLETS = ("•", "–", "-", "▶")
CAPTION_STARTS = ("figure ", "fig. ", "fig ", "table ", "diagram ")
PAGE_NUMBER = r"^\s*(?:\d{1,4}|[ivxlcdm]{1,8}|[IVXLCDM]{1,8})\s*$"
CARD_CODE = r"^[A-Z]{2}\d{4}$"
GRID_CODE = r"^(?:[A-Za-z]+\d+){3,}$"
ROMAN_RUN = r"^[IVXivx]{8,}$"
DINGBATS = r"[─-➿⭐-⭟-]"
SENTENCE_ENDS = ".!?:;)\"'"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once a row.

    Catalyst copies an expression to every place that refers to it, and
    conditional branches are not shared; a lambda variable is bound once.
    """
    return F.transform(F.array(value), use)[0]


def squeeze(c: Column) -> Column:
    """Runs of white space (no-break spaces too) become one space; none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", "")


def undecorate(c: Column) -> Column:
    """Braces and asterisks become spaces in texts that have both braces."""
    return F.when(F.contains(c, F.lit("{")) & F.contains(c, F.lit("}")), F.translate(c, "{}*", "   ")).otherwise(c)


@F.pandas_udf(T.StringType())
def compose(texts: pd.Series) -> pd.Series:
    """Canonical composition (NFC)."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def plain_letters(c: Column) -> Column:
    """Ligatures and curly quotes as plain letters and quotes, soft hyphens dropped."""
    for a, b in (("ﬁ", "fi"), ("ﬂ", "fl")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, "“”‘’­", "\"\"''")


def normalized(c: Column) -> Column:
    """Composed, plain, undecorated and squeezed."""
    return squeeze(undecorate(plain_letters(compose(c))))


def bullet(c: Column, bullets: tuple[str, ...] = BULLETS) -> Column:
    """The bullet that a text starts with, or the empty string; the first of the list wins."""
    start = F.ltrim(c)
    out = F.lit("")
    for b in reversed(bullets):
        out = F.when(F.startswith(start, F.lit(b)), F.lit(b)).otherwise(out)
    return F.when(c.isNotNull(), out)


def without_bullet(c: Column, bullets: tuple[str, ...] = BULLETS) -> Column:
    """The text after its bullet; texts without one stay as they are."""
    b = bullet(c, bullets)
    return F.when(b == "", c).otherwise(F.ltrim(F.substring(F.ltrim(c), F.length(b) + 1, F.length(c))))


def without_page_number(c: Column) -> Column:
    """A number of up to three digits glued to a capital is cut off."""
    return F.regexp_replace(c, r"^\d{1,3}\s*(?=[A-Z])", "")


def is_page_header(c: Column) -> Column:
    return F.rlike(c, F.lit(r"^\d{1,3}\s*[A-Z]"))


def is_page_number(c: Column) -> Column:
    return F.rlike(c, F.lit(PAGE_NUMBER))


def is_caption(c: Column) -> Column:
    return F.rlike(F.lower(F.trim(c)), F.lit("^(figure |fig\\. |fig |table |diagram )"))


def is_contents_entry(c: Column) -> Column:
    """Leader dots of a table of contents."""
    return F.contains(c, F.lit("....")) | F.contains(c, F.lit("…"))


def has_dingbat(c: Column) -> Column:
    return F.rlike(c, F.lit(DINGBATS))


def is_noise(c: Column) -> Column:
    """Empty, numeric, very short or code-like text, and text of one repeated character."""

    def test(t: Column) -> Column:
        word = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]", ""))
        one = F.length(F.replace(F.lower(t), F.substring(F.lower(t), 1, 1), F.lit(""))) == 0
        return (F.length(t) <= 2) | F.rlike(t, F.lit(rf"^\d+$|{CARD_CODE}|{GRID_CODE}|{ROMAN_RUN}")) | ((F.length(t) >= 4) & ((word < 0.5 * F.length(t)) | one))

    return let(squeeze(F.coalesce(c, F.lit(""))), test)


def is_label(c: Column) -> Column:
    """A short title: at most six words, all capitals, one capitalised word, or all words capitalised."""

    def words_fit(t: Column, words: Column) -> Column:
        bare = F.transform(words, lambda w: F.btrim(w, F.lit(",.;:!?")))
        alpha = F.filter(bare, lambda w: F.rlike(w, F.lit(r"^\p{L}")))
        upper = F.rlike(t, F.lit(r"\p{L}")) & (F.upper(t) == t)
        titled = let(alpha, lambda ws: F.forall(ws, lambda w: F.rlike(w, F.lit(r"^\p{Lu}"))) & ((F.size(words) == 1) | (F.size(ws) >= 2)))
        return (F.size(words) <= 6) & (upper | titled)

    def test(t: Column) -> Column:
        return F.rlike(t, F.lit(r"^\p{L}")) & let(F.split(t, " "), lambda words: words_fit(t, words))

    return let(squeeze(F.coalesce(c, F.lit(""))), test)


def is_heading(text: Column, size: Column, body: Column, ratio: float = 1.15, longest: int = 200) -> Column:
    """Larger than the body font by ``ratio`` and neither too long, too short nor a number."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(t) >= 3) & (F.length(t) <= longest) & (body > 0) & ~F.rlike(t, F.lit(r"^\d+$")) & (size >= body * ratio)


def continues(c: Column) -> Column:
    """Whether what follows belongs to this text: it is no title and does not end like a sentence."""

    def test(t: Column) -> Column:
        ended = F.contains(F.lit(SENTENCE_ENDS), F.right(t, F.lit(1)))
        return (t == "") | (((F.length(t) < 10) | (F.right(t, F.lit(1)) == "-") | F.rlike(t, F.lit(r"^\p{Ll}")) | ~ended) & ~is_label(t))

    return let(squeeze(F.coalesce(c, F.lit(""))), test)


def font_family(c: Column) -> Column:
    return F.substring_index(c, "-", 1)


@F.pandas_udf(T.StringType())
def slug(texts: pd.Series) -> pd.Series:
    """Lower-case ASCII name of at most 60 characters; ``anchor`` where nothing is left."""
    import re

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        bare = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
        return re.sub(r"[-\s]+", "-", re.sub(r"[^\w\s-]", "", bare)).strip("-")[:60] or "anchor"

    return texts.map(one)
