"""One run of the whole chain over made-up pages and over the driver's tables."""

import os

from pyspark.sql import functions as F

from quirespark import cli
from quirespark.plans.stages import Registry, Runner, Stage, document_stages, package, with_optional
from quirespark.sources.tables import version

from .conftest import rows

BOX = "struct<x0: double, y0: double, x1: double, y1: double>"
TEXTS = f"doc_id string, page_number int, primitive_id string, text string, line_count int, font_name string, font_size double, is_bold boolean, is_italic boolean, bbox_norm {BOX}"


def made_up(spark):
    def line(n, text, y, size=10.0):
        return ("d", 1, f"text:p0001:{n:03d}", text, 1, "A", size, False, False, (0.1, y, 0.8, y + 0.02))

    texts = [
        line(0, "Roll Roll the the die", 0.10, 20.0),
        line(1, "The storm die rolls on and is never", 0.14), line(2, "put away before the night ends.", 0.165),
        line(3, "Spend one ◈gem to pass the storm gate in peace.", 0.20),
        line(4, "Note that a boxed line stands here alone.", 0.50),
        line(5, "Figure 1. The gate at night", 0.83),
    ]
    pictures, _ = with_optional(spark, {}, {})
    schema = pictures["pictures"].schema
    blank = dict.fromkeys(schema.names)
    image = {**blank, "doc_id": "d", "page_number": 1, "kind": "image", "prim_ord": 0, "primitive_id": "image:p0001:000", "x0": 0.1, "y0": 0.6, "x1": 0.8, "y1": 0.8, "content_hash": "c" * 64}
    frame = {**blank, "doc_id": "d", "page_number": 1, "kind": "drawing", "prim_ord": 0, "primitive_id": "drawing:p0001:000", "x0": 0.05, "y0": 0.49, "x1": 0.9, "y1": 0.54, "path_count": 1, "is_decorative": False}
    return {
        "texts": spark.createDataFrame(texts, TEXTS),
        "pictures": spark.createDataFrame([tuple(r[c] for c in schema.names) for r in (image, frame)], schema),
        "symbols": spark.createDataFrame([(0, "gem", "◈", None)], "symbol_ord int, symbol_id string, token string, class_key string"),
        "terms": spark.createDataFrame([("t", "storm", ["gale"], "буря", [], True)], "term_id string, en_canonical string, en_aliases array<string>, ru_preferred string, ru_variants array<string>, lock_translation boolean"),
    }


def test_made_up_page(spark, tmp_path):
    inputs, versions = with_optional(spark, made_up(spark), {n: "1" for n in ("texts", "pictures", "symbols", "terms")})
    t = Runner(spark, str(tmp_path / "store")).run(list(document_stages().stages.values()), inputs, versions)
    got = {r["kind"]: r["content"] for r in t["blocks"].where("kind IN ('heading', 'callout', 'caption', 'figure')").collect()}
    assert got["heading"] == "Roll the die" and got["callout"].startswith("Note that") and "figure" in got and got["caption"].startswith("Figure 1")
    texts = [r[0] for r in t["blocks"].where("kind = 'paragraph'").orderBy("block_ord").select("content").collect()]
    assert texts[0] == "The storm die rolls on and is never put away before the night ends."
    assert rows(t["caption_links"].select(F.substring_index("figure_id", ":", -1), F.substring_index("caption_id", ":", -1))) == [("figure", "caption")]
    assert rows(t["assets"], "context") == [("figure",), ("unknown",)] and t["asset_classes"].count() == 2
    assert rows(t["symbol_refs"], "symbol_id") == [("gem",)]
    assert {r[0] for r in t["hints"].select("term_id").collect()} == {"t"} and rows(t["planned"].where(F.size("glossary_subset") > 0).select(F.col("glossary_subset")[0]["ru"]).distinct()) == [("буря",)]
    assert rows(t["doc_summary"], "page_count", "heading_count", "coverage") == [(1, 1, 1.0)]
    assert rows(t["catalog_new"], "doc_id", "page_count") == [("d", 1)] and rows(t["routes"], "route") == [("/docs/d/page/1",)]
    assert t["memory_new"].count() == t["units"].select("source_fingerprint").distinct().count()
    # Stored translations are taken the next time, and nothing new is stored.
    again = Runner(spark, str(tmp_path / "store")).run(list(document_stages().stages.values()), {**inputs, "memory": t["memory_new"]}, {**versions, "memory": "2"})
    assert again["run_summary"].first()["cached"] == t["results"].count() and again["memory_new"].isEmpty()


def test_patches_and_rules(spark, tmp_path):
    base = made_up(spark)
    patch = spark.createDataFrame([(0, 1, None, "force_fallback", None)], "patch_ord int, target_page int, target_block_id string, action string, value string")
    inputs, versions = with_optional(spark, {**base, "patches": patch}, {})
    t = Runner(spark, str(tmp_path / "store"), "off").run(document_stages().select(last="plan_summary"), inputs, versions)
    assert rows(t["pages"], "route") == [("facsimile",)] and t["units"].isEmpty() and rows(t["plan_summary"], "skipped_pages") == [([1],)]


def test_whole_run(spark, data, tmp_path):
    read = lambda name: spark.read.parquet(f"{data}/{name}.parquet")
    inputs = {"texts": read("text_primitives"), "terms": read("glossary_terms"), "titles": read("doc_summaries").select("doc_id", "title_en", "title_ru")}
    inputs, versions = with_optional(spark, inputs, {n: "1" for n in inputs})
    run = Runner(spark, str(tmp_path / "store"))
    t = run.run(list(document_stages().stages.values()), inputs, versions)
    assert {r.status for r in run.log} == {"completed"} and len(run.log) == len(document_stages().stages)
    assert t["blocks"].count() == t["blocks"].select("block_id").distinct().count() == t["localized"].count() == t["bundle"].count()
    assert t["results"].where("ru_text IS NULL").isEmpty() and t["hints"].count() > 0
    docs = inputs["texts"].select("doc_id").distinct().count()
    assert t["releases"].count() == docs == t["doc_summary"].count() == t["catalog_new"].count()
    made = package(t, str(tmp_path / "out"))
    assert len(made) == docs and all(os.path.exists(m["archive"]) == m["accepted"] for m in made if m["accepted"])


def test_inputs_are_known_by_their_files(spark, tmp_path):
    name = lambda: version(spark, str(tmp_path), "t")
    assert name() is None
    spark.range(2).write.parquet(str(tmp_path / "t.parquet"))
    first = name()
    assert first and first == name()
    spark.range(2).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert name() != first
    count = Stage("count", lambda t: t["in"].agg(F.count("*").alias("n")), ("in",))
    run = lambda n: Runner(spark, str(tmp_path / "store")).run([count], {"in": spark.range(n)})["count"].first()["n"]
    assert (run(2), run(3)) == (2, 3)


def test_cli_notices_changed_rows(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr("quirespark.session.local_session", lambda: spark)
    reg = Registry()
    reg.register(Stage("count", lambda t: t["texts"].agg(F.count("*").alias("n")), ("texts",)))
    monkeypatch.setattr(cli, "document_stages", lambda: reg)
    for source in ("text_primitives", "glossary_terms", "doc_summaries"):
        spark.read.parquet(f"{data}/{source}.parquet").write.parquet(str(tmp_path / f"{source}.parquet"))
    store = tmp_path / "store"
    made = lambda: (cli.main(["run", str(tmp_path), str(store)]), len(os.listdir(store / "count")))[1]
    assert (made(), made()) == (1, 1)
    spark.read.parquet(f"{data}/text_primitives.parquet").limit(5).write.mode("append").parquet(str(tmp_path / "text_primitives.parquet"))
    assert made() == 2
