import pytest
from pyspark.sql import functions as F

from quirespark.functions import geometry as g
from quirespark.functions import ids
from quirespark.functions import text as t


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,want", [("", True), (None, True), ("12", True), ("2024", True), ("AB0086", True), ("A1B2C3", True), ("IIIVVVXX", True), ("!!a!!", True), ("aaaa", True), ("Draw a card", False), ("Ёж ушёл", False)])
def test_noise(spark, text, want):
    assert one(spark, text, t.is_noise) is want


@pytest.mark.parametrize("text,want", [("Storm Die", True), ("STORM DIE NOW", True), ("Storm", True), ("Draw a card", False), ("storm", False), ("A B C D E F G", False), ("", False), (None, False), ("Лик Дунрок", True)])
def test_label(spark, text, want):
    assert one(spark, text, t.is_label) is want


@pytest.mark.parametrize("text,want", [("", True), ("short", True), ("a line that ends mid-", True), ("lower case first letter here.", True), ("Ends like a sentence here.", False), ("Goes on without an end", True), ("Storm Die", False)])
def test_continues(spark, text, want):
    assert one(spark, text, t.continues) is want


def test_normal_forms(spark):
    assert one(spark, "  a  b c ", t.squeeze) == "a b c"
    assert one(spark, "{x} *y*", t.undecorate) == " x   y "
    assert one(spark, "{x *y*", t.undecorate) == "{x *y*"
    assert one(spark, "“ﬁn­e” é", t.normalized) == '"fine" é'
    assert one(spark, "• – item", t.without_bullet) == "– item"
    assert one(spark, "12Chapter", t.without_page_number) == "Chapter"
    assert one(spark, "Über das Élan!", t.slug) == "uber-das-elan"
    assert one(spark, "Ядро", t.slug) == "anchor"
    assert one(spark, None, t.normalized) is None


def test_headings(spark):
    df = spark.createDataFrame([("Title", 14.0, 11.0), ("Title", 12.0, 11.0), ("ab", 20.0, 11.0), ("12345", 20.0, 11.0), ("Title", 14.0, 0.0)], "a string, s double, b double")
    assert [r["h"] for r in df.select(t.is_heading(F.col("a"), F.col("s"), F.col("b")).alias("h")).collect()] == [True, False, False, False, False]


def test_ids(spark):
    df = spark.createDataFrame([("doc", 3, 7)], "d string, p int, n int")
    r = df.select(ids.block_id(F.col("d"), F.col("p"), F.col("n"), F.lit("list")).alias("b"), ids.unit_id(F.col("d"), F.col("p"), F.col("n")).alias("u"), ids.fingerprint(F.lit("x")).alias("f")).first()
    assert tuple(r) == ("doc:p0003:b007:list", "doc:u0003_07", "2d711642b726b044")


def test_geometry(spark):
    box = lambda *v: tuple(F.lit(float(x)) for x in v)
    df = spark.range(1)
    r = df.select(
        g.grid(F.lit(0.05), 0.02).alias("even"), g.contains(box(0, 0, 1, 1), box(0, 0, 1, 1)).alias("c"), g.overlap_area(box(0, 0, 0.5, 0.5), box(0.25, 0.25, 1, 1)).alias("o"),
        g.normalize(F.lit(5.0), F.lit(0.0)).alias("z"), g.x_overlap(box(0, 0, 0.2, 1), box(0.1, 0, 0.6, 1)).alias("x"),
    ).first()
    assert r["even"] == 2 and r["c"] and r["o"] == 0.0625 and r["z"] == 0.0 and abs(r["x"] - 0.5) < 1e-9
