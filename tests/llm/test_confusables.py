import pytest

from quirespark.llm import confusables as c

from .common import rows

CHANGED = {
    "Draw 5 cards as shоwn": "Draw 5 cards as shown", "choose а companion": "choose a companion", "KESHRAS ОАТН": "KESHRAS OATH", "рядом c картой": "рядом с картой", "shufﬂe": "shuffle", "Pelñar": "Pelñar", "Ѕеіѕеі": "Seisei",
    "Koгдa": "Когда", "Обет Boppac": "Обет Воррас", "Draw １９": "Draw 19", "a b": "a b", "a　b": "a b", "st­orm": "storm", "z​ero": "zero", "﻿x": "x", "Keep": "Keep", "Gate⁠": "Gate", "GULZАR МАЅК": "GULZAR MASK", "Rükesh Маѕk": "Rükesh Mask",
}
KEPT = ["(греч. «λόγος»)", "(δ = 3)", "Ω a", "👩‍🚀 x", "🧙‍♂ a", "½ ² ™ № 45°", "“quoted” — … • –", "Pelñar", "phase лежит", "по-русски: как", "Ёлка й", "", "12", "naïve"]


@pytest.mark.parametrize("text", CHANGED)
def test_changed(text):
    assert c.usual(text) == CHANGED[text]
    assert c.usual(CHANGED[text]) == CHANGED[text]


@pytest.mark.parametrize("text", KEPT)
def test_kept(text):
    assert c.usual(text) == text


def test_skeletons():
    assert c.skeleton("Воррас") == c.skeleton("Boppac") and c.skeleton("ﬁrst") == c.skeleton("first") and c.skeleton("Gate") != c.skeleton("Gale")


def test_records(spark):
    p = spark.createDataFrame([("d", "t0", "Обет Воррас"), ("d", "t1", None), ("d", "t2", ""), ("d", "t3", "shоwn"), ("d", "t3", "shоwn"), (None, "t4", "a b"), ("d", "t5", "x" * 5000 + "​")], "doc_id string, primitive_id string, text string").selectExpr("*", "'x' AS usual", "'y' AS skeleton")
    g = spark.createDataFrame([("d", "i0", "glossary_ref", "Boppac"), ("d", "i1", "glossary_ref", None), ("d", "i2", "text", "shоwn"), ("d", "i3", "glossary_ref", "Воррас")], "doc_id string, inline_id string, kind string, surface_form string")
    assert rows(c.found(p, g)) == sorted([("glossary_ref", "d", "i0"), ("text_primitive", "d", "t3"), ("text_primitive", None, "t4"), ("text_primitive", "d", "t5")], key=repr)
    assert c.found(p.limit(0), g.limit(0)).count() == 0


def test_long_s_and_armenian_letters_in_sentences():
    assert c.usual("the laſt gate stands open and ŉ waits") == "the last gate stands open and ʼn waits"
    assert c.usual("ſt") == "st"
    assert c.usual("roll the stօrm die") == "roll the storm die"
    assert c.usual("roll the օս die")[9:11] == "ou"
    assert c.usual("Սահմանը բաց է") == "Սահմանը բաց է"


def test_groups_settle_what_nothing_around_does(spark):
    texts = ["OATH CAPE held", "CAPE of OATH", "the OATH", "ОАТН САРЕ", "Draw the ОАТН САРЕ now", "Сор", "." * 90 + " ОАТН", "Ꭺshen gate"]
    p = spark.createDataFrame([("d", f"t{k}", t) for k, t in enumerate(texts + 4 * ["the OATH of the CAPE"])], "doc_id string, primitive_id string, text string")
    g = spark.createDataFrame([], "doc_id string, inline_id string, kind string, surface_form string")
    got = {r["item_key"]: r["usual"] for r in c.usual_forms(p, g).collect()}
    assert got == {"t3": "OATH CAPE", "t4": "Draw the OATH CAPE now", "t6": "." * 90 + " OATH", "t7": "Ashen gate"}


def test_table_of_the_library(spark):
    table = c.Prototypes.of(spark)
    assert len(table.table) > 2000
    assert table.skeleton("ΡаураӀ") == table.skeleton("Paypal") and table.skeleton("Gate") != table.skeleton("Gale")
    for text in [*CHANGED.values(), *KEPT]:
        assert c.usual(text, table) == text
    for text, want in CHANGED.items():
        assert c.usual(text, table) == want
