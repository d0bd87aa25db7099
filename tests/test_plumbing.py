import json
import os

import pytest
from pyspark.sql import functions as F

from quirespark.plans.stages import Registry, Runner, Stage, document_stages
from quirespark.sinks import files as sinks
from quirespark.sources import files as sources
from quirespark.streaming import events

from .conftest import rows


def test_stage_selection():
    reg = Registry()
    for name in "abcd":
        reg.register(Stage(name, lambda t: None))
    names = lambda **k: [s.name for s in reg.select(**k)]
    assert names(first="b", last="c") == ["b", "c"]
    assert names(first="b", only=["a", "d"], exclude=["d"]) == ["a"]
    with pytest.raises(ValueError):
        reg.select(only=["z"])
    with pytest.raises(ValueError):
        reg.register(Stage("a", lambda t: None))
    assert document_stages().select(last="primitives")


def test_runner_reuses_and_notices_changes(spark, tmp_path):
    calls = []

    def double(tables):
        calls.append(1)
        return tables["in"].select((F.col("id") * 2).alias("id"))

    stages = [Stage("double", double, ("in",)), Stage("sum", lambda t: t["double"].agg(F.sum("id").alias("s")), ("double",))]
    run = lambda mode, version: Runner(spark, str(tmp_path), mode).run(stages, {"in": spark.range(4)}, {"in": version})
    assert run("read_write", "1")["sum"].first()["s"] == 12
    run("read_write", "1")
    assert len(calls) == 1
    run("read_write", "2")
    run("force_refresh", "1")
    run("off", "1")
    assert len(calls) == 4
    bad = Runner(spark, str(tmp_path))
    with pytest.raises(KeyError):
        bad.run([Stage("x", lambda t: None, ("nowhere",))], {})
    assert rows(bad.stage_runs(), "stage", "status") == [("x", "failed")]


def test_page_ranges(spark):
    assert sources.parse_pages("1,5,8-10, 9") == [1, 5, 8, 9, 10]
    for bad in ("", "0", "5-3", "a"):
        with pytest.raises(ValueError):
            sources.parse_pages(bad)
    df = spark.range(5).withColumnRenamed("id", "page_number")
    assert rows(sources.keep_pages(df, [1, 9])) == [(1,)] and sources.keep_pages(df, None).count() == 5


def test_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", None)], "z string, a int")
    path = str(tmp_path / "j")
    sinks.write_json(df, path)
    sinks.write_json(df, path, append=True)
    assert sources.json_records(spark, path, "z string, a int", lines=True).count() == 4
    assert rows(sinks.canonical_json(df)) == [('{"a":1,"z":"b"}',), ('{"z":"a"}',)]
    (tmp_path / "one.json").write_text(json.dumps({"k": [1, 2]}))
    assert sources.raw_json(spark, str(tmp_path / "one.json")).select(F.variant_get("value", "$.k[1]", "int")).first()[0] == 2
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        sources.json_records(spark, str(tmp_path / "bad.json"), "k int").collect()


def test_yaml_errors(tmp_path):
    pytest.importorskip("yaml")
    with pytest.raises(FileNotFoundError):
        sources.yaml_pack(str(tmp_path / "no.yaml"))
    (tmp_path / "e.yaml").write_text("")
    (tmp_path / "l.yaml").write_text("- 1")
    for name in ("e", "l"):
        with pytest.raises(ValueError):
            sources.yaml_pack(str(tmp_path / f"{name}.yaml"))
    (tmp_path / "m.yaml").write_text("a: 1")
    assert sources.yaml_pack(str(tmp_path / "m.yaml")) == {"a": 1}


def test_strategies_and_flags(spark):
    t = spark.createDataFrame([("d", 1, "text"), ("d", 1, "lines"), ("d", 2, "text")], "doc_id string, page_number int, extraction_strategy string")
    assert rows(sources.first_strategy(t), "page_number", "extraction_strategy") == [(1, "lines"), (2, "text")]
    assert tuple(spark.range(1).select(sources.font_flags(F.lit(18)).alias("f")).first()["f"]) == (True, True, False)


def test_bundle_and_release(spark, tmp_path):
    pages = spark.createDataFrame([("a", 1), ("b", 1)], "doc_id string, page_number int")
    out = str(tmp_path / "bundle")
    sinks.write_bundle(pages, out)
    sinks.write_bundle(pages.where("doc_id = 'a'").withColumn("page_number", F.lit(7)), out)
    assert rows(spark.read.parquet(out), "doc_id", "page_number") == [("a", 7), ("b", 1)]
    images = spark.createDataFrame([("h" * 20, bytearray(b"1"), "png"), ("h" * 20, bytearray(b"1"), "png"), ("x", bytearray(b"2"), "exe")], "content_hash string, content binary, extension string")
    assets = str(tmp_path / "assets")
    assert len(rows(sinks.write_binaries(images, assets))) == 1 and os.listdir(assets) == ["h" * 16 + ".png"]
    listing = sources.manifest(spark, assets)
    assert rows(sinks.inventory(listing)) == [("png", 1, 1)]
    got = sinks.release(assets, str(tmp_path / "r.tgz"), {"doc_id": "a"}, True)
    assert got["sha256"] == sinks.file_hash(str(tmp_path / "r.tgz")) and "archive" not in sinks.release(assets, "", {}, False)
    assert sinks.folder_hash(assets) and sinks.folder_hash(str(tmp_path / "none")) is None


def test_stream_counts_like_batch(spark, tmp_path, data):
    table = spark.read.parquet(f"{data}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    table.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = events.read_stream(spark, str(tmp_path / "in"), table.schema)
    q = events.hourly(stream).writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert rows(spark.table("hourly")) == rows(events.hourly(table))
    once = events.first_results(spark.readStream.schema(table.schema).parquet(str(tmp_path / "in")), ["event_type"], "ts", "1000 days")
    q = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    q.awaitTermination()
    assert spark.table("once").count() == table.select("event_type").distinct().count()


class FakeRect:
    def __init__(self, x0, y0, x1, y1):
        self.x0, self.y0, self.x1, self.y1 = x0, y0, x1, y1
        self.width, self.height = x1 - x0, y1 - y0


class FakePage:
    rotation = 90

    def __init__(self, words):
        self.words, self.rect = words, FakeRect(0, 0, 612, 792)

    def get_text(self, _):
        if self.words is None:
            raise ValueError("broken page")
        spans = [{"text": w, "bbox": (10 * k, 5, 10 * k + 8, 15), "font": "F-Bold", "size": 9.996, "flags": 18} for k, w in enumerate(self.words)]
        return {"blocks": [{"type": 1}, {"type": 0, "lines": [{"spans": spans, "dir": (-1.0, 0.0)}]}]}

    def get_images(self, full):
        return [(7,)]

    def get_image_rects(self, _):
        return [FakeRect(0, 0, 10, 10), FakeRect(20, 0, 30, 10)]


class FakeDocument:
    metadata, page_count = {"title": "T", "author": ""}, 3

    def __init__(self, content):
        if content == b"bad":
            raise ValueError("no document")

    def __getitem__(self, k):
        return FakePage([["Roll", "", "die"], None, ["six"]][k])

    def get_toc(self):
        return [[1, "One", 1]]

    def extract_image(self, xref):
        return {"image": b"x", "width": 2, "height": 3, "ext": "png", "cs-name": "DeviceRGB"}


def test_documents_through_their_dictionaries(spark, tmp_path):
    from quirespark.sources import pdf

    (tmp_path / "a.pdf").write_bytes(b"good")
    (tmp_path / "b.pdf").write_bytes(b"bad")
    path = str(tmp_path)
    docs = {r["doc_id"][-5:]: r for r in pdf.documents(spark, path, FakeDocument).collect()}
    assert docs["b.pdf"]["error"] == "no document" and docs["a.pdf"]["page_count"] == 3 and docs["a.pdf"]["metadata"] == {"title": "T"} and docs["a.pdf"]["outline"][0]["title"] == "One"
    pages = {r["page_number"]: r for r in pdf.pages(spark, path, None, FakeDocument).where("page_number is not null").collect()}
    assert pages[1]["char_count"] == 7 and pages[1]["fonts_used"] == ["F-Bold"] and pages[1]["rotation"] == 90 and pages[2]["error"] == "broken page"
    got = rows(pdf.spans(spark, path, None, FakeDocument), "page_number", "block_index", "span_index", "text", "font_size", "is_bold", "is_italic", "is_monospace", "direction")
    assert got == [(1, 1, 0, "Roll", 10.0, True, True, False, "rtl"), (1, 1, 1, "die", 10.0, True, True, False, "rtl"), (3, 1, 0, "six", 10.0, True, True, False, "rtl")]
    assert rows(pdf.spans(spark, path, [3, 9], FakeDocument), "page_number") == [(3,)]
    assert pdf.spans(spark, path, [9], FakeDocument).count() == 0
    assert pdf.images(spark, path, [1], FakeDocument).count() == 2
    assert rows(pdf.primitives(spark, path, [1], FakeDocument), "primitive_id", "prim_ord", "text", "is_bold") == [("text:p0001:000", 0, "Roll", True), ("text:p0001:001", 1, "die", True)]


def test_hashes_of_outputs(tmp_path):
    from quirespark.sinks import files

    (tmp_path / "sub").mkdir()
    for name in ("b.json", "stage_manifest.json", "sub/c.json"):
        (tmp_path / name).write_text(name)
    import hashlib

    assert files.output_hashes(str(tmp_path)) == {"b.json": hashlib.sha256(b"b.json").hexdigest()} and files.output_hashes(str(tmp_path / "none")) == {}


def test_rules_registry(spark, data):
    from quirespark.operators import quality
    from quirespark.plans import translation_queries

    issues = translation_queries.rule_issues(spark, data)
    assert {r["rule_id"] for r in issues.select("rule_id").distinct().collect()} == set(quality.RULES)
    for bad in (lambda: quality.evaluate({}), lambda: quality.evaluate({}, ["translation.empty"]), lambda: quality.evaluate({}, ["none"])):
        with pytest.raises((KeyError, ValueError)):
            bad()
