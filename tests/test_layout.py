import pytest

from quirespark.operators import assets, furniture, layout, links, overlays, primitives

from .conftest import rows

SCHEMA = "doc_id string, page_number int, kind string, prim_ord int, primitive_id string, x0 double, y0 double, x1 double, y1 double"


def prims(spark, items, extra=""):
    return primitives.complete(spark.createDataFrame([("d", p, k, n, f"{k}:p{p:04d}:{n:03d}", *map(float, b), *x) for p, k, n, b, *x in items], SCHEMA + extra))


def test_bands_and_columns(spark):
    p = prims(spark, [(1, "text", 0, (0.1, 0.10, 0.9, 0.15)), (1, "text", 1, (0.1, 0.30, 0.45, 0.40)), (1, "text", 2, (0.55, 0.31, 0.9, 0.40)), (1, "text", 3, (0.1, 0.42, 0.45, 0.5))])
    got = rows(layout.columns(layout.bands(p)), "prim_ord", "band_index", "column_index")
    assert got == [(0, 0, None), (1, 1, 0), (2, 1, 1), (3, 1, 0)]


def test_hard_page(spark):
    """Two columns, a figure, a callout and a doubtful table: the score is 1 less .1625 twice, .045 and .06."""
    p = prims(
        spark,
        [
            (1, "text", 0, (0.1, 0.10, 0.4, 0.20), "a", None, None, None, None, None, None),
            (1, "text", 1, (0.6, 0.10, 0.9, 0.20), "b", None, None, None, None, None, None),
            (1, "image", 2, (0.6, 0.22, 0.9, 0.30), None, "h", None, None, None, None, None),
            (1, "table", 3, (0.05, 0.05, 0.45, 0.30), None, None, 2, 1, 2, "text", None),
            (1, "text", 4, (0.12, 0.21, 0.3, 0.25), "c", None, None, None, None, None, None),
            (1, "drawing", 5, (0.55, 0.08, 0.95, 0.21), None, None, None, None, None, None, 3),
            (1, "text", 6, (0.12, 0.26, 0.3, 0.28), "e", None, None, None, None, None, None),
        ],
        ", text string, content_hash string, rows int, cols int, cell_count int, extraction_strategy string, path_count int",
    )
    r = layout.regions(p)
    kinds = sorted(x["kind_hint"] for x in r.collect())
    assert kinds == ["band", "callout", "column", "column", "figure", "table"]
    order = layout.reading_order(r)
    none = furniture.page_furniture(furniture.candidates(p))
    got = layout.page_confidence(r, order, none).first()
    assert abs(got["confidence"] - 0.57) < 1e-9 and got["route"] == "hybrid"
    assert layout.unassigned(r, order).count() == 0
    assert rows(layout.edges(r).where("edge_type = 'contains'"), "src") == [("reg:1:0",)] * 5


def test_interruption(spark):
    two = lambda n, y: [(1, "text", n, (0.1, y, 0.4, y + 0.05)), (1, "text", n + 1, (0.6, y, 0.9, y + 0.05))]
    p = prims(spark, [*two(0, 0.1), (1, "text", 2, (0.1, 0.4, 0.9, 0.45)), *two(3, 0.7)])
    order = layout.reading_order(layout.regions(p))
    assert [x["flow_role"] for x in order.orderBy("sequence_index").collect()] == ["main", "main", "interruption", "main", "main"]


def test_furniture(spark):
    items = [(p, "text", 0, (0.1, 0.02, 0.5, 0.05), "Head") for p in range(1, 5)] + [(p, "text", 1, (0.45, 0.95, 0.55, 0.97), str(p)) for p in range(1, 5)] + [(p, "text", 2, (0.1, 0.4, 0.9, 0.5), f"text {p}") for p in range(1, 5)]
    p = prims(spark, items, ", text string")
    f = furniture.candidates(p)
    assert rows(f, "candidate_id", "repetition_rate") == [("furn:header:000", 1.0), ("furn:page_number:001", 1.0)]
    assert rows(furniture.mask(p, f), "prim_ord") == [(2,)] * 4
    assert len(rows(furniture.templates(f))) == 1
    assert furniture.candidates(p.where("page_number = 1")).count() == 0
    assert furniture.candidates(p.limit(0)).count() == 0


def test_assets(spark):
    p = prims(spark, [(1, "image", 0, (0, 0, 0.05, 0.05), "b"), (1, "image", 1, (0, 0, 0.5, 0.5), "a"), (2, "image", 0, (0, 0, 0.5, 0.5), "a")], ", content_hash string")
    occ = assets.occurrences(p)
    assert rows(occ, "asset_id", "page_number", "context") == [("asset:raster:000", 1, "figure"), ("asset:raster:000", 2, "figure"), ("asset:raster:001", 1, "inline")]
    assert rows(assets.classes(occ), "class_key", "occurrences") == [("a", 2), ("b", 1)]


def test_greedy_is_not_mutual_best(spark):
    scored = spark.createDataFrame([("d", 1, "f1", "c1", 0, 0, 0.9), ("d", 1, "f1", "c2", 0, 1, 0.8), ("d", 1, "f2", "c1", 1, 0, 0.7), ("d", 1, "f2", "c2", 1, 1, 0.1)], "doc_id string, page_number int, figure_id string, caption_id string, figure_ord int, caption_ord int, score double")
    assert rows(links.greedy_links(scored), "figure_id", "caption_id") == [("f1", "c1"), ("f2", "c2")]


@pytest.mark.parametrize("empty", [True, False])
def test_symbols(spark, empty):
    p = prims(spark, [(1, "text", 0, (0, 0, 1, 1), "★ costs {x}"), (1, "text", 1, (0, 0, 1, 1), "{x} two"), (1, "text", 2, (0, 0, 1, 1), None)], ", text string")
    p = p.limit(0) if empty else p
    pack = spark.createDataFrame([("s", "{x}")], "symbol_id string, token string")
    got = rows(assets.symbol_candidates(assets.token_matches(p, pack), assets.dingbats(p)), "candidate_id", "anchor_type")
    assert got == ([] if empty else [("sym:p0001:000", "inline"), ("sym:p0001:001", "line_prefix"), ("sym:p0001:002", "inline")])


def test_resolving_and_tagging(spark):
    regions = spark.createDataFrame([("d", 1, "r1", "figure", 0.5, 0.1), ("d", 1, "r0", "figure", 0.1, 0.5), ("d", 1, "r2", "band", 0.0, 0.0)], "doc_id string, page_number int, region_id string, kind_hint string, y0 double, x0 double")
    blocks = spark.createDataFrame([("d", 1, 0, "f0", "figure", "", "p1"), ("d", 1, 1, "c0", "caption", " Fig 1 ", None), ("d", 1, 2, "c1", "caption", "Fig 1", None)], "doc_id string, page_number int, block_ord int, block_id string, kind string, content string, asset_ref string")
    assert rows(links.resolve_figures(regions, blocks), "region_id", "block_id") == [("r0", "f0")]
    texts = spark.createDataFrame([("d", 1, "t", "Fig 1")], "doc_id string, page_number int, primitive_id string, text string")
    assert rows(links.resolve_captions(texts, blocks), "block_id") == [("c1",)]
    cand = spark.createDataFrame([("d", 1, "p1", "k0", "s0", 0.5), ("d", 1, "p1", "k1", "s1", 0.9), ("d", 1, "p1", "k2", "s2", 0.9)], "doc_id string, page_number int, primitive_id string, candidate_id string, symbol_id string, confidence double")
    assert rows(assets.tag_figures(blocks, cand), "block_id", "alt_text") == [("c0", None), ("c1", None), ("f0", "s1")]
    pages = spark.createDataFrame([("d", 1), ("d", 2)], "doc_id string, page_number int")
    assert [len(r["found"]) for r in assets.by_page(pages, found=cand).orderBy("page_number").collect()] == [3, 0]


def test_overlays(spark):
    p = prims(spark, [(1, "text", 0, (0.1, 0.1, 0.2, 0.2), "a"), (2, "text", 0, (0.1, 0.1, 0.2, 0.2), "b")], ", text string")
    r = layout.regions(p)
    assert overlays.primitives(p, 2).count() == 1 and overlays.regions(r).count() == 2
    assert rows(overlays.reading_order(r, layout.reading_order(r)), "label") == [("0",), ("0",)]
    c = layout.page_confidence(r, layout.reading_order(r), furniture.page_furniture(furniture.candidates(p)))
    assert rows(overlays.confidence(c), "colour") == [("green",), ("green",)]
