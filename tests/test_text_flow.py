from pyspark.sql import functions as F

from quirespark.operators import bundle, enrich, quality, structure, translation

from .conftest import rows

BLOCK = "doc_id string, page_number int, block_ord int, block_id string, kind string, level int, content string"


def blocks(spark, *items):
    return spark.createDataFrame([("d", p, n, f"b{p}{n}", k, lv, c) for p, n, k, lv, c in items], BLOCK)


def texts(spark, *items):
    return spark.createDataFrame([("d", 1, n, f"t{n}", c, s, False, False) for n, (c, s) in enumerate(items)], "doc_id string, page_number int, prim_ord int, primitive_id string, text string, font_size double, is_bold boolean, is_italic boolean")


def test_lists_go_on_over_noise(spark):
    c = structure.classify(texts(spark, ("• one thing", 10.0), ("12", 10.0), ("• two things", 10.0), ("A plain line stands here.", 10.0), ("- three things", 10.0), ("Big Title", 20.0)))
    got = rows(structure.list_runs(c).select(F.array_join("items", "|")))
    assert got == [("one thing|two things",), ("three things",)] or got == sorted(got)
    assert rows(structure.blocks(c), "block_ord", "kind", "level") == [(0, "list", None), (1, "paragraph", None), (2, "list", None), (3, "heading", 1)]


def test_mode_takes_first_seen(spark):
    df = spark.createDataFrame([("d", 12.0, 0), ("d", 9.0, 1), ("d", 9.0, 2), ("d", 12.0, 3)], "doc_id string, font_size double, ord int")
    assert rows(structure.first_seen_mode(df, ["doc_id"], "font_size", "ord"), "font_size") == [(12.0,)]


def test_paragraphs_fold(spark):
    b = blocks(spark, (1, 0, "paragraph", None, "The first part goes"), (1, 1, "paragraph", None, "on until here."), (1, 2, "paragraph", None, "A new sentence starts."), (1, 3, "heading", 1, "Title"), (1, 4, "paragraph", None, "Another text ends."))
    got = rows(structure.merge_paragraphs(b), "block_ord", "content")
    assert got == [(0, "The first part goes on until here."), (2, "A new sentence starts."), (4, "Another text ends.")]


def test_lines_and_phrases(spark):
    lines = [["the storm die", "storm die rolls", "ab", "b c"], ["storm die", " ", "die", "now {x} *", None, "roll the die"], [], ["a the", "the  the b"]]
    df = spark.createDataFrame([(x,) for x in lines], "l array<string>")
    assert [r[0] for r in df.select(structure.join_lines(F.col("l"))).collect()] == ["the storm die rolls ab b c", "storm die now x roll the die", "", "a the the b"]
    texts = ["roll the die roll the die now now", "a a b a a b", "go go now go go now x", "one", " one ", "", None, "Do not Do not open open", "a b c d a b c d a b c d e"]
    want = ["roll the die now", "a a b", "go go now x", "one", " one ", "", None, "Do not open", "a b c d a b c d e"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, t string")
    assert [r[0] for r in df.orderBy("k").select(structure.without_repeats(F.col("t"))).collect()] == want


def test_runs_merge(spark):
    s = spark.createDataFrame([("b", 0, "a", "F-Bold", 10.0, True, False), ("b", 1, "b", "F-Bold", 12.0, True, False), ("b", 2, "c", "F", 9.0, False, False), ("b", 3, "d", "F", 9.0, None, None)], "block_id string, span_ord int, text string, font_name string, font_size double, is_bold boolean, is_italic boolean")
    assert rows(structure.merge_runs(s), "run_ord", "text", "font_size") == [(0, "ab", 12.0), (1, "cd", 9.0)]


def test_section_path_excludes_own_heading(spark):
    b = blocks(spark, (1, 0, "heading", 1, "A"), (1, 1, "heading", 2, "B"), (1, 2, "paragraph", None, "x"), (1, 3, "heading", 1, "C"), (1, 4, "paragraph", None, "y"))
    got = {r["block_ord"]: r["section_path"] for r in translation.section_paths(b).collect()}
    assert got == {0: [], 1: ["A"], 2: ["A", "B"], 3: ["A", "B"], 4: ["C"]}


def test_units(spark):
    b = blocks(spark, (1, 0, "heading", 1, "Title of it"), *[(1, n, "paragraph", None, f"sentence number {n} goes here.") for n in range(1, 6)], (1, 6, "paragraph", None, "Storm Die"), (1, 7, "paragraph", None, " "))
    u = translation.plan_units(b, max_nodes=2).orderBy("unit_id").collect()
    assert [len(r["nodes"]) for r in u] == [1, 2, 2, 1, 1]
    assert [r["style_hint"] for r in u][:2] == ["heading", "paragraph"]
    assert u[0]["context_before"] == "" and u[1]["context_before"] == "Title of it" and u[-1]["context_after"] == ""
    assert u[1]["section_path"] == ["Title of it"]


def test_memory(spark):
    r = spark.createDataFrame([("f", "u1", ["a"], ["x"]), ("f", "u2", ["a"], ["y"]), ("g", "u3", ["a"], ["a"]), ("", "u4", ["a"], ["z"]), ("h", "u5", ["a"], [None])], "source_fingerprint string, unit_id string, sources array<string>, translations array<string>")
    none = spark.createDataFrame([], "source_fingerprint string, translations array<string>")
    store = translation.memory_store(none, r)
    assert rows(store) == [("f", ["x"])]
    assert translation.memory_store(store, r).count() == 0
    units = spark.createDataFrame([("u1", "f"), ("u2", "f"), ("u9", "")], "unit_id string, source_fingerprint string")
    assert rows(translation.memory_lookup(units, store), "unit_id", "cached") == [("u1", True), ("u2", True), ("u9", False)]


def test_placeholders_and_responses(spark):
    df = spark.createDataFrame([("Roll the Storm Die and the storm.",)], "t string")
    locked = translation.lock_terms(F.col("t"), ["storm", "storm die"])
    r = df.select(locked.alias("a"), translation.unlock_terms(locked, ["буря", "кубик"]).alias("b"), translation.lost_placeholders(locked, F.lit("«PH_01»")).alias("c")).first()
    assert tuple(r) == ("Roll the «PH_01» and the «PH_00».", "Roll the кубик and the буря.", ["«PH_00»"])
    raw = '{"unit_id": "u", "translations": [{"inline_id": "a", "ru_text": "x"}'
    df = spark.createDataFrame([(raw + "]}",), (raw,), (raw[:-2],), ("```json\n" + raw + "]}\n```",), ("nothing",)], "t string")
    got = [None if r[0] is None else [tuple(x) for x in r[0]] for r in df.select(translation.parse_response(F.col("t"))).collect()]
    assert got == [[("a", "x")]] * 4 + [None]


def test_glossary_links_do_not_overlap(spark):
    runs = spark.createDataFrame([("d", 1, "b", "i0", 0, "Storm Die, storm die and storm", None), ("d", 1, "b", "i1", 1, "storm", "буря")], "doc_id string, page_number int, block_id string, inline_id string, node_ord int, text string, ru_text string")
    terms = spark.createDataFrame([("a", "storm die", [], "кубик", []), ("b", "storm", [], "буря", [])], "term_id string, en_canonical string, en_aliases array<string>, ru_preferred string, ru_variants array<string>")
    assert rows(translation.glossary_links(runs, terms), "term_id", "start", "end") == [("a", 0, 9), ("b", 25, 30)]
    assert len(rows(translation.glossary_links(runs, terms, first_only=False))) == 3


def test_gateway_retries(spark):
    units = spark.createDataFrame([("u", [("i", "ok"), ("j", "bad")])], "unit_id string, nodes array<struct<inline_id: string, source_text: string>>")

    def gateway(text):
        if text == "bad":
            raise ValueError("no")
        return text.upper()

    assert rows(translation.translate(units, gateway, attempts=2)) == [("u", "i", "OK", 1, None), ("u", "j", None, 2, "no")]


def test_navigation_and_search(spark):
    b = blocks(spark, (1, 0, "heading", 2, "Orphan"), (1, 1, "heading", 1, "Top"), (2, 0, "heading", 2, "Child"), (2, 1, "heading", 2, "Contents ...."), (2, 2, "paragraph", None, "storm storm"), (2, 3, "paragraph", None, "calm"))
    assert rows(enrich.navigation(b), "label", "parent") == [("Child", "b11"), ("Orphan", None), ("Top", None)]
    docs = enrich.search_documents(b)
    assert [tuple(r) for r in docs.where("kind = 'paragraph'").orderBy("block_id").select("heading", F.size("section_path")).collect()] == [("Contents ....", 2), ("Contents ....", 2)]
    assert rows(enrich.search(docs, "STORM"), "key") == [("b22",)]
    assert enrich.search(docs, "  ").count() == 0


def test_quality(spark):
    r = spark.createDataFrame([("d", 1, "a", "text", ""), ("d", 1, "b", "text", None), ("d", 1, "c", "text", "да"), ("d", 1, "e", " ", None)], "doc_id string, page_number int, inline_id string, text string, ru_text string")
    issues = quality.missing_translation(r).unionByName(quality.empty_translation(r))
    assert rows(issues, "rule_id", "item") == [("translation.empty", "a"), ("translation.missing", "a"), ("translation.missing", "b")]
    assert quality.gate(issues).first()["accepted"] is False
    assert quality.gate(issues.limit(0)).first()["accepted"] is True
    assert quality.with_ids(issues).select("issue_id").distinct().count() == 3
    t = spark.createDataFrame([("d", 1, "t", 2, 2, [(0, 0), (2, 0)]), ("d", 1, "u", 1, 1, [])], "doc_id string, page_number int, block_id string, rows int, cols int, cells array<struct<row: int, col: int>>")
    assert rows(quality.table_structure(t), "item", "message") == [("t", "cell out of bounds"), ("u", "dimensions without cells")]
    c = spark.createDataFrame([("d", 1, "f", "figure", "x", None), ("d", 1, "c", "caption", None, "p"), ("d", 1, "p", "paragraph", None, None)], "doc_id string, page_number int, block_id string, kind string, caption_block_id string, parent_block_id string")
    assert rows(quality.caption_links(c), "message") == [("caption does not exist",), ("parent is neither figure nor table",)]
    g = spark.createDataFrame([("d", 1, "r0"), ("d", 1, "r0"), ("d", 1, "r1")], "doc_id string, page_number int, region_id string")
    e = spark.createDataFrame([("d", 1, "contains", "r0", "r9"), ("d", 1, "contains", "r1", "r1")], "doc_id string, page_number int, edge_type string, src string, dst string")
    assert sorted(x["message"] for x in quality.region_graph(g, e).collect()) == ["dst of an edge does not exist", "edge onto itself", "region id is not unique"]


def test_bundle(spark):
    df = spark.createDataFrame([("en", ""), ("en", None), ("en", "ru")], "a string, b string")
    assert [r[0] for r in df.select(bundle.pick(F.col("a"), F.col("b"), "ru")).collect()] == ["en", "en", "ru"]
    r = bundle.routes(spark.createDataFrame([("d", 2), ("e", 0), ("f", None)], "doc_id string, page_count int"))
    assert rows(r, "route", "prev_page", "next_page") == [("/docs/d/page/1", None, 2), ("/docs/d/page/2", 1, None)]
    n = spark.createDataFrame([("b", 0, "a"), ("b", 1, "b "), ("b", 2, "c"), ("b", 3, None), ("b", 4, "d")], "k string, o int, text string")
    assert rows(bundle.spaced_text(n, ["k"], ["o"])) == [("b", "a b cd")]
    s = spark.createDataFrame([("x", "Label", "p.svg", ""), ], "symbol_id string, label string, svg_path string, alt_text string")
    refs = spark.createDataFrame([("x", ""), ("y", None), ("x", "own")], "symbol_id string, alt_text string")
    assert sorted(r["alt"] for r in bundle.with_symbols(refs, s.withColumnRenamed("alt_text", "alt_text")).collect()) == ["Label", "own", "y"]


def test_callouts_wrap_at_first_member(spark):
    b = blocks(spark, (1, 0, "paragraph", None, "a"), (1, 1, "list", None, "x\ny"), (1, 2, "paragraph", None, "c"), (1, 3, "paragraph", None, "d"))
    m = spark.createDataFrame([("d", 1, "b11", "r1"), ("d", 1, "b13", "r1"), ("d", 1, "b13", "r2")], "doc_id string, page_number int, block_id string, region_id string")
    assert rows(structure.wrap_callouts(b, m), "block_ord", "kind", "content") == [(0, "paragraph", "a"), (1, "callout", "x\ny\nd"), (2, "paragraph", "c")]


def test_symbol_tokens_split_in_order(spark):
    df = spark.createDataFrame([("a {x} b {x} {y}",), ("{y} {x}",), (None,), ("plain",)], "text string")
    got = [[tuple(p) for p in r["parts"]] for r in structure.split_symbols(df, [("X", "{x}"), ("Y", "{y}")]).collect()]
    assert got == [[("text", "a "), ("symbol", "X"), ("text", " b {x} "), ("symbol", "Y")], [("text", "{y} "), ("symbol", "X")], [], [("text", "plain")]]


def test_outputs_and_fallback(spark):
    df = spark.createDataFrame([("Sure:\n```json\n{\"a\": 1}\n```",)], "t string")
    assert df.select(translation.clean_output(F.col("t"))).first()[0] == '{"a": 1}'

    def bad(text):
        raise ValueError("down")

    assert translation.with_fallback(bad, str.upper)("x") == "X"
    u = translation.plan_units(blocks(spark, (1, 0, "paragraph", None, "a text goes here.")))
    assert '"source_text":"a text goes here."' in u.select(translation.user_prompt()).first()[0]


def test_html_and_contents(spark):
    b = blocks(spark, (1, 0, "heading", 1, "A<B"), (1, 1, "list", None, "x\ny"), (1, 2, "paragraph", None, None))
    assert [r["html"] for r in bundle.html(b).orderBy("block_ord").collect()] == ["<h1>A&lt;B</h1>", "<ul><li>x</li><li>y</li></ul>", "<p></p>"]
    e = spark.createDataFrame([("d", "a", 1, None), ("d", "b", 2, "a")], "doc_id string, anchor_id string, page_number int, parent string")
    assert rows(bundle.contents(e), "path", "depth") == [(["a", "b"], 2), (["a"], 1)]
