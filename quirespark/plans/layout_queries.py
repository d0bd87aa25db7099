"""Queries on the geometry of pages: furniture, regions, assets, symbols and captions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import assets, furniture, layout, links, overlays, primitives, structure
from ..sources.tables import table
from . import sql
from .text_queries import _CLASS, prims

#: The boxes of the tables vary in width and font, so that clusters need a coarse grid and a low rate.
RATE, STEP = 0.1, 0.5
R6 = ("x0", "y0", "x1", "y1")


def _rounded(*names: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in names]


def _found(spark: SparkSession, d: str) -> DataFrame:
    return furniture.candidates(prims(spark, d), min_rate=RATE, step=STEP)


def furniture_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d).select("doc_id", "candidate_id", "furniture_type", *_rounded(*R6, "repetition_rate", "confidence"), F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"), "text_sample")


FURNITURE_SQL = f"""WITH {sql.FURNITURE} SELECT doc_id, candidate_id, furniture_type, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, round(pc / total, 6) AS repetition_rate, round(least(1.0, pc / total / 0.1), 6) AS confidence,
array_to_string(pages, ',') AS pages, text_sample FROM furn"""


def page_furniture(spark: SparkSession, d: str) -> DataFrame:
    return furniture.page_furniture(_found(spark, d)).select("doc_id", "page_number", F.array_join("furniture_ids", ",").alias("furniture_ids"), *_rounded("furniture_fraction"))


_PF = f"""{sql.FURNITURE}, fp AS (SELECT doc_id, candidate_id, greatest(x1 - x0, 0) * greatest(y1 - y0, 0) AS size, unnest(pages) AS page_number FROM furn),
pf AS (SELECT doc_id, page_number, string_agg(candidate_id, ',' ORDER BY candidate_id) AS furniture_ids, least(1.0, sum(size)) AS furniture_fraction FROM fp GROUP BY ALL)"""
PAGE_FURNITURE_SQL = f"WITH {_PF} SELECT doc_id, page_number, furniture_ids, round(furniture_fraction, 6) AS furniture_fraction FROM pf"


def furniture_templates(spark: SparkSession, d: str) -> DataFrame:
    return furniture.templates(_found(spark, d)).select("doc_id", "template_id", F.array_join("furniture_ids", ",").alias("furniture_ids"), F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"))


TEMPLATES_SQL = f"WITH {_PF} SELECT doc_id, 'tpl:' || substr(sha256(replace(furniture_ids, ',', ':')), 1, 8) AS template_id, furniture_ids, string_agg(page_number, ',' ORDER BY page_number) AS pages FROM pf GROUP BY doc_id, furniture_ids"


def furniture_mask(spark: SparkSession, d: str) -> DataFrame:
    return furniture.mask(prims(spark, d), _found(spark, d)).select("doc_id", "primitive_id")


MASK_SQL = f"""WITH {sql.FURNITURE}, fp AS (SELECT doc_id, x0, y0, x1, y1, unnest(pages) AS page_number FROM furn)
SELECT doc_id, primitive_id FROM p WHERE NOT EXISTS (SELECT 1 FROM fp WHERE fp.doc_id = p.doc_id AND fp.page_number = p.page_number AND CASE WHEN greatest(p.x1 - p.x0, 0) * greatest(p.y1 - p.y0, 0) > 0
 THEN greatest(least(p.x1, fp.x1) - greatest(p.x0, fp.x0), 0) * greatest(least(p.y1, fp.y1) - greatest(p.y0, fp.y0), 0) > 0.5 * (greatest(p.x1 - p.x0, 0) * greatest(p.y1 - p.y0, 0)) ELSE fp.x0 <= p.x0 AND fp.y0 <= p.y0 AND fp.x1 >= p.x1 AND fp.y1 >= p.y1 END)"""


def bands(spark: SparkSession, d: str) -> DataFrame:
    return layout.bands(prims(spark, d)).select("doc_id", "primitive_id", "band_index")


BANDS_SQL = f"WITH {sql.BANDS} SELECT doc_id, primitive_id, band_index FROM b"


def merged_spans(spark: SparkSession, d: str) -> DataFrame:
    return layout.merged_spans(layout.bands(prims(spark, d))).select("doc_id", "page_number", "band_index", "span", *_rounded("s0", "s1"))


SPANS_SQL = f"WITH {sql.BANDS} SELECT doc_id, page_number, band_index, span, round(s0, 6) AS s0, round(s1, 6) AS s1 FROM sp"


def columns(spark: SparkSession, d: str) -> DataFrame:
    return layout.columns(layout.bands(prims(spark, d))).select("doc_id", "primitive_id", "band_index", "column_index")


COLUMNS_SQL = f"WITH {sql.BANDS} SELECT doc_id, primitive_id, band_index, column_index FROM c"


def regions(spark: SparkSession, d: str) -> DataFrame:
    return layout.regions(prims(spark, d)).select("doc_id", "page_number", "region_id", "parent_region_id", "kind_hint", "band_index", "column_index", "column_count", *_rounded(*R6, "confidence"))


REGIONS_SQL = f"WITH {sql.REGIONS} SELECT doc_id, page_number, region_id, parent_region_id, kind_hint, band_index, column_index, column_count, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, CAST(confidence AS DOUBLE) AS confidence FROM r"


def region_edges(spark: SparkSession, d: str) -> DataFrame:
    return layout.edges(layout.regions(prims(spark, d)))


EDGES_SQL = f"""WITH {sql.REGIONS} SELECT doc_id, page_number, 'contains' AS edge_type, parent_region_id AS src, region_id AS dst FROM r WHERE parent_region_id IS NOT NULL
UNION ALL SELECT * FROM (SELECT doc_id, page_number, 'adjacent_to' AS edge_type, region_id AS src, lead(region_id) OVER (PARTITION BY doc_id, page_number ORDER BY band_index) AS dst FROM r WHERE kind_hint = 'band') WHERE dst IS NOT NULL"""


def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(layout.regions(prims(spark, d)))


ORDER_SQL = f"WITH {sql.ORDER} SELECT doc_id, page_number, sequence_index, region_id, kind_hint, flow_role, band_index, column_index, CAST(confidence AS DOUBLE) AS confidence FROM o"


def unassigned_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions without a place in an order of which the second band was lost."""
    r = layout.regions(prims(spark, d))
    return layout.unassigned(r, layout.reading_order(r).where("band_index <> 1"))


UNASSIGNED_SQL = f"WITH {sql.ORDER} SELECT doc_id, page_number, region_id FROM r WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.band_index <> 1 AND o.doc_id = r.doc_id AND o.page_number = r.page_number AND o.region_id = r.region_id) AND NOT (kind_hint = 'band' AND EXISTS (SELECT 1 FROM cc WHERE cc.doc_id = r.doc_id AND cc.page_number = r.page_number AND cc.band_index = r.band_index))"


def page_confidence(spark: SparkSession, d: str) -> DataFrame:
    p = prims(spark, d)
    r = layout.regions(p)
    out = layout.page_confidence(r, layout.reading_order(r), furniture.page_furniture(furniture.candidates(p, min_rate=RATE, step=STEP)))
    return out.select("doc_id", "page_number", *_rounded("confidence"), "route")


CONFIDENCE_SQL = f"""WITH {sql.ORDER}, {_PF.replace(sql.PRIMS + ', ', '', 1)}, a AS (SELECT doc_id, page_number, min(confidence) AS rm, count(*) AS n, coalesce(max(column_count), 1) AS cols, count(DISTINCT CASE WHEN kind_hint = 'column' THEN band_index END) AS st FROM r GROUP BY ALL), q AS (SELECT doc_id, page_number, min(confidence) AS om, count(*) AS m FROM o GROUP BY ALL),
s AS (SELECT a.doc_id, a.page_number, greatest(0, least(1, 1 - ((1 - rm) * 0.25 + (1 - coalesce(om, 1)) * 0.25 + (n - coalesce(m, 0) - st) / n * 0.15 + CASE WHEN cols <= 1 THEN 0.0 WHEN cols = 2 THEN 0.3 ELSE 0.6 END * 0.15 + least(greatest(coalesce(furniture_fraction, 0) - 0.5, 0) * 2, 1) * 0.1))) AS c
 FROM a LEFT JOIN q USING (doc_id, page_number) LEFT JOIN pf USING (doc_id, page_number))
SELECT doc_id, page_number, round(CAST(c AS DOUBLE), 6) AS confidence, CASE WHEN c >= 0.6 THEN 'semantic' WHEN c >= 0.3 THEN 'hybrid' ELSE 'facsimile' END AS route FROM s"""


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    """The texts of the pages, some of them made images, tables and drawings by their number, so that every kind of region occurs."""
    p = prims(spark, d)
    o = F.col("prim_ord")
    image, tab, draw = o % 11 == 3, o % 11 == 5, o % 11 == 7
    wide = lambda c, by: F.when(draw, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c) + by))).when(tab & (o % 2 == 1), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c) + by / 2))).otherwise(F.col(c))
    return p.withColumns({
        "kind": F.when(image, "image").when(tab, "table").when(draw, "drawing").otherwise("text"), "x0": wide("x0", -0.5), "y0": wide("y0", -0.06), "x1": wide("x1", 0.5), "y1": wide("y1", 0.06),
        "rows": F.when(tab, o % 3 + 1).cast("int"), "cols": F.when(tab, F.floor(o / 3) % 2 + 1).cast("int"), "cell_count": F.when(tab, (o % 3 + 1) * (F.floor(o / 3) % 2 + 1)).cast("int"),
        "extraction_strategy": F.when(tab, F.when(o % 4 < 2, "lines_strict").when(o % 4 == 2, "lines").otherwise("text")), "is_decorative": F.when(draw, o % 4 == 0), "content_hash": F.when(image, F.sha2("primitive_id", 256)),
    })


_WIDE = "CASE WHEN {c}k = 'drawing' THEN greatest(0.0, least(1.0, {c} {by})) WHEN {c}k = 'table' AND prim_ord % 2 = 1 THEN greatest(0.0, least(1.0, {c} {half})) ELSE {c} END AS {c}"
_KIND = "CASE prim_ord % 11 WHEN 3 THEN 'image' WHEN 5 THEN 'table' WHEN 7 THEN 'drawing' ELSE 'text' END"
_GROWN = ", ".join(_WIDE.format(c=c, by=by, half=half).replace(f"{c}k", _KIND) for c, by, half in (("x0", "- 0.5", "- 0.25"), ("y0", "- 0.06", "- 0.03"), ("x1", "+ 0.5", "+ 0.25"), ("y1", "+ 0.06", "+ 0.03")))
_MIXED = sql.PRIMS.replace("p AS", "pp AS", 1) + f""", p AS (SELECT * EXCLUDE (x0, y0, x1, y1), {_GROWN}, {_KIND} AS kind, prim_ord % 3 + 1 AS rows_, prim_ord // 3 % 2 + 1 AS cols_, CASE WHEN prim_ord % 4 < 2 THEN 0.9 WHEN prim_ord % 4 = 2 THEN 0.8 ELSE 0.7 END AS base, prim_ord % 4 = 0 AS decor FROM pp)"""
_INSIDE = "{a}.x0 <= t.x0 AND {a}.y0 <= t.y0 AND {a}.x1 >= t.x1 AND {a}.y1 >= t.y1"
_AREA = "(greatest({a}.x1 - {a}.x0, 0) * greatest({a}.y1 - {a}.y0, 0))"
_PARTS = f""", tb AS (SELECT a.doc_id, a.page_number, a.band_index, a.primitive_id, a.prim_ord, a.x0, a.y0, a.x1, a.y1, a.rows_, a.cols_, any_value(a.base) AS base, coalesce(avg(CASE WHEN {_INSIDE.format(a='a')} THEN 1.0 ELSE 0.0 END) FILTER (t.primitive_id IS NOT NULL), 0) AS ov
 FROM c a LEFT JOIN c t ON t.kind = 'text' AND t.doc_id = a.doc_id AND t.page_number = a.page_number AND t.band_index = a.band_index WHERE a.kind = 'table' GROUP BY ALL),
tc AS (SELECT *, round_even(least(1, greatest(0, base + CASE WHEN rows_ <= 1 AND cols_ <= 1 THEN -0.25 ELSE 0 END + CASE WHEN rows_ * cols_ <= 2 THEN -0.15 ELSE 0 END + CASE WHEN rows_ >= 2 AND cols_ >= 2 AND rows_ * cols_ >= 4 THEN 0.05 ELSE 0 END + CASE WHEN ov > 0.5 THEN -0.2 ELSE 0 END)), 2) AS cf FROM tb),
td AS (SELECT *, rows_ <= 1 AND cols_ <= 1 AND ov > 0 AND cf < 0.5 AS box FROM tc),
en AS (SELECT a.doc_id, a.page_number, a.band_index, a.prim_ord, a.primitive_id, a.x0, a.y0, a.x1, a.y1, count(*) AS n, sum({_AREA.format(a='t')}) / any_value({_AREA.format(a='a')}) AS density
 FROM c a JOIN c t ON t.kind = 'text' AND t.doc_id = a.doc_id AND t.page_number = a.page_number AND {_INSIDE.format(a='a')} WHERE a.kind = 'drawing' AND NOT a.decor AND {_AREA.format(a='a')} >= 0.005 GROUP BY ALL),
r0 AS (SELECT * FROM rt
 UNION ALL SELECT doc_id, page_number, band_index, 'figure', NULL, x0, y0, x1, y1, NULL, 0.8, 2, prim_ord FROM c WHERE kind = 'image'
 UNION ALL SELECT doc_id, page_number, band_index, CASE WHEN box THEN 'callout' ELSE 'table' END, NULL, x0, y0, x1, y1, NULL, CASE WHEN box THEN 0.55 ELSE cf END, 3, prim_ord FROM td
 UNION ALL SELECT doc_id, page_number, band_index, 'callout', NULL, x0, y0, x1, y1, NULL, 0.6 + CASE WHEN n >= 3 THEN 0.1 ELSE 0 END + CASE WHEN density > 0.1 THEN 0.05 ELSE 0 END, 4, prim_ord FROM en)"""
_MIXED_ORDER = (
    sql.ORDER.replace(sql.PRIMS, _MIXED, 1).replace("r0 AS (", "rt AS (", 1).replace(",\nr1 AS", _PARTS + ",\nr1 AS", 1)
    .replace("WHEN kind_hint = 'sidebar' THEN 'aside'", "WHEN kind_hint IN ('sidebar', 'callout') THEN 'aside'").replace("CASE WHEN kind_hint IN ('band', 'column') THEN 0 ELSE 2 END", "CASE WHEN kind_hint IN ('band', 'column') THEN 0 WHEN kind_hint IN ('figure', 'table') THEN 1 ELSE 2 END")
)


def mixed_regions(spark: SparkSession, d: str) -> DataFrame:
    r = layout.regions(_mixed(spark, d))
    return r.select("doc_id", "page_number", "region_id", "kind_hint", "band_index", "column_index", "parent_region_id", *_rounded(*R6, "confidence"))


MIXED_REGIONS_SQL = f"WITH {_MIXED_ORDER} SELECT doc_id, page_number, region_id, kind_hint, band_index, column_index, parent_region_id, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, round(CAST(confidence AS DOUBLE), 6) AS confidence FROM r"


def mixed_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(layout.regions(_mixed(spark, d))).withColumn("confidence", F.round("confidence", 6))


MIXED_ORDER_SQL = f"WITH {_MIXED_ORDER} SELECT doc_id, page_number, sequence_index, region_id, kind_hint, flow_role, band_index, column_index, round(CAST(confidence AS DOUBLE), 6) AS confidence FROM o"


def mixed_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Confidence and flags of pages with every kind of region."""
    p = _mixed(spark, d)
    r = layout.regions(p)
    none = p.select("doc_id", "page_number", F.lit(0.0).alias("furniture_fraction")).distinct()
    both = layout.page_confidence(r, layout.reading_order(r), none).join(layout.canonical_flags(r), ["doc_id", "page_number"])
    return both.select("doc_id", "page_number", *_rounded("confidence"), "route", "has_tables", "has_figures", "has_callouts", "estimated_columns")


MIXED_CONFIDENCE_SQL = f"""WITH {_MIXED_ORDER}, a AS (SELECT doc_id, page_number, min(confidence) AS rm, count(*) AS n, coalesce(max(column_count), 1) AS cols, count(DISTINCT CASE WHEN kind_hint = 'column' THEN band_index END) AS st,
 bool_or(kind_hint = 'table') AS ht, bool_or(kind_hint = 'figure') AS hf, bool_or(kind_hint = 'callout') AS hc FROM r GROUP BY ALL), q AS (SELECT doc_id, page_number, min(confidence) AS om, count(*) AS m FROM o GROUP BY ALL),
s AS (SELECT a.*, greatest(0, least(1, 1 - ((1 - rm) * 0.25 + (1 - coalesce(om, 1)) * 0.25 + (n - coalesce(m, 0) - st) / n * 0.15 + CASE WHEN cols <= 1 THEN 0.0 WHEN cols = 2 THEN 0.3 ELSE 0.6 END * 0.15 + (ht::INT + hf::INT + hc::INT) * 0.2 * 0.1))) AS c FROM a LEFT JOIN q USING (doc_id, page_number))
SELECT doc_id, page_number, round(CAST(c AS DOUBLE), 6) AS confidence, CASE WHEN c >= 0.6 THEN 'semantic' WHEN c >= 0.3 THEN 'hybrid' ELSE 'facsimile' END AS route, ht AS has_tables, hf AS has_figures, hc AS has_callouts, CAST(cols AS INT) AS estimated_columns FROM s"""


def _pictures(spark: SparkSession, d: str) -> DataFrame:
    """Image candidates of the furniture profile as pictures of the pages that they name."""
    f = table(spark, d, "furniture_profile").where(F.col("source_primitive_kind") == "image").select("doc_id", "candidate_id", "content_hash", "bbox_norm", "page_numbers").distinct()
    pages = f.select("doc_id", "candidate_id", "content_hash", *[F.col(f"bbox_norm.{c}").alias(c) for c in R6], F.explode("page_numbers").alias("page_number"))
    return primitives.complete(pages.withColumns({"kind": F.lit("image"), "prim_ord": F.element_at(F.split("candidate_id", ":"), -1).cast("int"), "primitive_id": F.concat_ws("@", "candidate_id", F.col("page_number").cast("string"))}))


_PICS = """pic0 AS (SELECT DISTINCT doc_id, candidate_id, content_hash, bbox_norm, page_numbers FROM furniture_profile WHERE source_primitive_kind = 'image'),
pic AS (SELECT doc_id, candidate_id, content_hash, bbox_norm.x0 AS x0, bbox_norm.y0 AS y0, bbox_norm.x1 AS x1, bbox_norm.y1 AS y1, unnest(page_numbers) AS page_number FROM pic0),
pc AS (SELECT *, candidate_id || '@' || page_number AS primitive_id, TRY_CAST(string_split(candidate_id, ':')[-1] AS INT) AS prim_ord FROM pic)"""


def asset_occurrences(spark: SparkSession, d: str) -> DataFrame:
    return assets.occurrences(_pictures(spark, d)).select("doc_id", "asset_id", "occurrence_id", "page_number", "primitive_id", "context")


_OCC = f"""{_PICS}, oc AS (SELECT *, printf('asset:raster:%03d', dense_rank() OVER (PARTITION BY doc_id ORDER BY content_hash) - 1) AS asset_id FROM pc WHERE content_hash IS NOT NULL)"""
OCCURRENCES_SQL = f"""WITH {_OCC} SELECT doc_id, asset_id, printf('%s:p%04d:%02d', asset_id, page_number, row_number() OVER (PARTITION BY doc_id, asset_id, page_number ORDER BY prim_ord, primitive_id) - 1) AS occurrence_id, page_number, primitive_id,
CASE WHEN greatest(x1 - x0, 0) * greatest(y1 - y0, 0) < 0.01 THEN 'inline' WHEN greatest(x1 - x0, 0) * greatest(y1 - y0, 0) >= 0.04 THEN 'figure' ELSE 'unknown' END AS context FROM oc"""


def asset_classes(spark: SparkSession, d: str) -> DataFrame:
    return assets.classes(assets.occurrences(_pictures(spark, d))).select("doc_id", "asset_id", "class_key", "occurrences", F.size("pages").alias("pages"))


CLASSES_SQL = f"WITH {_OCC} SELECT doc_id, asset_id, content_hash AS class_key, count(*) AS occurrences, CAST(count(DISTINCT page_number) AS INT) AS pages FROM oc GROUP BY ALL"

#: A small pack of symbols by token.
TOKENS = [("sym.flame", "{flame}"), ("sym.range", "Range"), ("sym.speed", "Speed"), ("sym.mage", "🧙")]


def symbol_candidates(spark: SparkSession, d: str) -> DataFrame:
    p = prims(spark, d)
    pack = spark.createDataFrame(TOKENS, "symbol_id string, token string")
    return assets.symbol_candidates(assets.token_matches(p, pack), assets.dingbats(p)).select("doc_id", "page_number", "candidate_id", "primitive_id", "evidence_source", "symbol_id", "raw", "anchor_type", "is_classified")


_SYM = f"""{sql.PRIMS}, tk(symbol_id, token) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in TOKENS)}),
sy AS (SELECT doc_id, page_number, primitive_id, prim_ord, 0 AS rank, 'text_token' AS evidence_source, symbol_id, token AS raw, CASE WHEN starts_with(ltrim(text), token) AND (substr(ltrim(text), length(token) + 1, 1) = '' OR regexp_matches(substr(ltrim(text), length(token) + 1, 1), '^\\s')) THEN 'line_prefix' ELSE 'inline' END AS anchor_type, TRUE AS is_classified FROM p JOIN tk ON contains(text, token)
 UNION ALL SELECT doc_id, page_number, primitive_id, prim_ord, 1, 'dingbat', NULL, unnest(list_distinct(regexp_extract_all(text, '{sql.DINGBAT}'))), 'inline', FALSE FROM p),
sc AS (SELECT *, printf('sym:p%04d:%03d', page_number, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY rank, prim_ord, primitive_id, symbol_id NULLS FIRST, raw) - 1) AS candidate_id FROM sy)"""
SYMBOLS_SQL = f"WITH {_SYM} SELECT doc_id, page_number, candidate_id, primitive_id, evidence_source, symbol_id, raw, anchor_type, is_classified FROM sc"


def symbol_summary(spark: SparkSession, d: str) -> DataFrame:
    return assets.symbol_summary(symbol_candidates(spark, d)).withColumn("symbol_ids", F.array_join("symbol_ids", ","))


SUMMARY_SQL = f"WITH {_SYM} SELECT doc_id, count(*) AS total, count(*) FILTER (is_classified) AS classified, count(*) FILTER (NOT is_classified) AS unclassified, coalesce(string_agg(DISTINCT symbol_id, ',' ORDER BY symbol_id), '') AS symbol_ids FROM sc GROUP BY doc_id"


def symbol_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Pictures that a pack names by content hash; the pack is taken from the commonest pictures."""
    pics = _pictures(spark, d)
    pack = pics.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 5").select(F.concat(F.lit("sym."), F.substring("content_hash", 1, 6)).alias("symbol_id"), F.col("content_hash").alias("class_key"))
    return assets.hash_matches(pics, pack).select("doc_id", "page_number", "primitive_id", "symbol_id", "anchor_type")


HASHES_SQL = f"""WITH {_PICS}, k AS (SELECT content_hash FROM pc WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 5)
SELECT doc_id, page_number, primitive_id, 'sym.' || substr(content_hash, 1, 6) AS symbol_id, CASE WHEN x1 - x0 < 0.05 AND y1 - y0 < 0.05 THEN 'inline' ELSE 'block_attached' END AS anchor_type FROM pc JOIN k USING (content_hash)"""


def _figures_captions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Bold texts stand for figures and short texts for captions, so that their geometry can be scored."""
    p = prims(spark, d).withColumn("block_id", F.col("primitive_id")).withColumn("ord", F.col("prim_ord"))
    return p.where("is_bold"), p.where((F.length("text") < 40) & ~F.coalesce("is_bold", F.lit(False)))


_FC = f"""{sql.PRIMS}, f AS (SELECT * FROM p WHERE is_bold), c AS (SELECT * FROM p WHERE length(text) < 40 AND NOT coalesce(is_bold, FALSE)),
j AS (SELECT f.doc_id, f.page_number, f.primitive_id AS figure_id, c.primitive_id AS caption_id, f.prim_ord AS fo, c.prim_ord AS co, (c.y0 + c.y1) / 2 - (f.y0 + f.y1) / 2 AS dist, greatest(least(f.x1, c.x1) - greatest(f.x0, c.x0), 0) / least(greatest(f.x1 - f.x0, 0.001), greatest(c.x1 - c.x0, 0.001)) AS ov FROM f JOIN c USING (doc_id, page_number)),
sc AS (SELECT *, least(1.0, 0.6 * ov + 0.4 * greatest(0.0, CASE WHEN dist >= 0 THEN 1.0 ELSE 0.8 END - abs(dist) * 3)) AS score FROM j WHERE abs(dist) <= 0.30)"""
SCORES_SQL = f"WITH {_FC} SELECT doc_id, page_number, figure_id, caption_id, round(score, 6) AS score FROM sc WHERE score >= 0.10"


def caption_scores(spark: SparkSession, d: str) -> DataFrame:
    return links.score_pairs(*_figures_captions(spark, d)).select("doc_id", "page_number", "figure_id", "caption_id", *_rounded("score"))


def caption_links(spark: SparkSession, d: str) -> DataFrame:
    return links.greedy_links(links.score_pairs(*_figures_captions(spark, d))).withColumn("score", F.round("score", 6))


# Pairs of a page, best first, as text; a pair is kept where neither of its sides has been.
_BEST = f"""{_FC}, one AS (SELECT doc_id, page_number, chr(1) || figure_id || chr(2) || caption_id || chr(3) AS pair, figure_id, caption_id, score, fo, co FROM sc WHERE score >= 0.10),
pg AS (SELECT doc_id, page_number, list(pair ORDER BY score DESC, fo, co, figure_id, caption_id) AS pairs FROM one GROUP BY ALL),
kp AS (SELECT doc_id, page_number, list_reduce(pairs, lambda acc, x: CASE WHEN contains(acc, split_part(x, chr(2), 1) || chr(2)) OR contains(acc, chr(2) || split_part(x, chr(2), 2)) THEN acc ELSE acc || x END) AS kept FROM pg),
bl AS (SELECT one.doc_id, one.page_number, figure_id, caption_id, round(CAST(score AS DOUBLE), 6) AS score FROM one JOIN kp ON kp.doc_id = one.doc_id AND kp.page_number = one.page_number AND contains(kept, pair))"""
LINKS_SQL = f"WITH {_BEST} SELECT * FROM bl"


def linked_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the pages with what the links make of them."""
    b = prims(spark, d).select("doc_id", "page_number", F.concat_ws("/", "doc_id", "primitive_id").alias("block_id"))
    own = caption_links(spark, d).select(F.concat_ws("/", "doc_id", "figure_id").alias("figure_id"), F.concat_ws("/", "doc_id", "caption_id").alias("caption_id"))
    return links.apply_links(b, own)


LINKED_SQL = f"""WITH {_BEST} SELECT p.doc_id, p.page_number, p.doc_id || '/' || p.primitive_id AS block_id, p.doc_id || '/' || a.caption_id AS caption_block_id, p.doc_id || '/' || b.figure_id AS parent_block_id
FROM p LEFT JOIN bl a ON a.doc_id = p.doc_id AND a.figure_id = p.primitive_id LEFT JOIN bl b ON b.doc_id = p.doc_id AND b.caption_id = p.primitive_id"""


def sequential_links(spark: SparkSession, d: str) -> DataFrame:
    return links.sequential_links(*_figures_captions(spark, d)).withColumn("score", F.round("score", 6))


SEQUENTIAL_SQL = f"""WITH {_FC}, a AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY prim_ord, primitive_id) AS n FROM f), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY prim_ord, primitive_id) AS n FROM c)
SELECT a.doc_id, a.page_number, a.primitive_id AS figure_id, b.primitive_id AS caption_id, round(CAST(greatest(0.3, 1 - 0.1 * abs(a.prim_ord - b.prim_ord)) AS DOUBLE), 6) AS score FROM a JOIN b USING (doc_id, page_number, n)"""


def callout_members(spark: SparkSession, d: str) -> DataFrame:
    """Texts whose centre lies in a band of at least a fifth of the page."""
    p = prims(spark, d)
    tall = layout.regions(p).where((F.col("kind_hint") == "band") & (F.col("y1") - F.col("y0") > 0.2))
    return structure.callout_members(p, tall)


MEMBERS_SQL = f"""WITH {sql.REGIONS} SELECT p.doc_id, p.page_number, p.primitive_id, r.region_id FROM p JOIN r ON r.doc_id = p.doc_id AND r.page_number = p.page_number AND r.kind_hint = 'band' AND r.y1 - r.y0 > 0.2
WHERE (p.x0 + p.x1) / 2 BETWEEN r.x0 AND r.x1 AND (p.y0 + p.y1) / 2 BETWEEN r.y0 AND r.y1"""


def canonical_flags(spark: SparkSession, d: str) -> DataFrame:
    return layout.canonical_flags(layout.regions(prims(spark, d)))


FLAGS_SQL = f"WITH {sql.REGIONS} SELECT doc_id, page_number, FALSE AS has_tables, FALSE AS has_figures, FALSE AS has_callouts, CAST(coalesce(max(column_count), 1) AS INT) AS estimated_columns FROM r GROUP BY ALL"


def region_overlays(spark: SparkSession, d: str) -> DataFrame:
    return overlays.regions(layout.regions(prims(spark, d))).select("layer", "doc_id", "page_number", *_rounded(*R6), "colour", "label")


OVERLAY_SQL = f"""WITH {sql.REGIONS} SELECT 'regions' AS layer, doc_id, page_number, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, CASE kind_hint WHEN 'band' THEN 'grey' WHEN 'column' THEN 'blue' ELSE 'teal' END AS colour, region_id || ' ' || kind_hint AS label FROM r"""


def wrapped_callouts(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of the pages with the texts of tall bands as callouts."""
    b = structure.classify(prims(spark, d)).where("kind_hint <> 'skip'").select("doc_id", "page_number", F.col("prim_ord").alias("block_ord"), F.col("primitive_id").alias("block_id"), F.lit("paragraph").alias("kind"), F.lit(None).cast("int").alias("level"), F.col("clean").alias("content"))
    return structure.wrap_callouts(b, callout_members(spark, d).withColumnRenamed("primitive_id", "block_id"))


# The fragments share the table of primitives, which is named once.
WRAPPED_SQL = f"""WITH {_CLASS}, {sql.REGIONS.replace(sql.PRIMS + ', ', '', 1)}, mb AS (SELECT p.doc_id, p.page_number, p.primitive_id, min(r.region_id) AS region_id FROM p JOIN r ON r.doc_id = p.doc_id AND r.page_number = p.page_number AND r.kind_hint = 'band' AND r.y1 - r.y0 > 0.2
WHERE (p.x0 + p.x1) / 2 BETWEEN r.x0 AND r.x1 AND (p.y0 + p.y1) / 2 BETWEEN r.y0 AND r.y1 GROUP BY ALL),
bk AS (SELECT doc_id, page_number, prim_ord AS block_ord, primitive_id AS block_id, 'paragraph' AS kind, clean AS content FROM cls WHERE kind_hint <> 'skip'),
al AS (SELECT bk.* FROM bk LEFT JOIN mb ON mb.doc_id = bk.doc_id AND mb.page_number = bk.page_number AND mb.primitive_id = bk.block_id WHERE mb.region_id IS NULL
 UNION ALL SELECT bk.doc_id, bk.page_number, min(block_ord), region_id, 'callout', string_agg(content, chr(10) ORDER BY block_ord, content) FROM bk JOIN mb ON mb.doc_id = bk.doc_id AND mb.page_number = bk.page_number AND mb.primitive_id = bk.block_id GROUP BY bk.doc_id, bk.page_number, region_id)
SELECT doc_id, page_number, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY block_ord, block_id) - 1 AS INT) AS block_ord, block_id, kind, CAST(NULL AS INT) AS level, content FROM al"""


def geometry(spark: SparkSession, d: str) -> DataFrame:
    box = g.box()
    return prims(spark, d).select("doc_id", "primitive_id", F.round(g.area(*box), 6).alias("area"), F.round(g.normalize(F.col("x0") * 612 - 10, F.lit(600.0)), 6).alias("clamped"), g.grid(F.col("x0"), 0.02).alias("grid"), g.contains((F.lit(0.05), F.lit(0.05), F.lit(0.95), F.lit(0.95)), box).alias("inside"), F.round(g.overlap_area(box, (F.lit(0.0), F.lit(0.0), F.lit(0.5), F.lit(0.5))), 6).alias("overlap"))


GEOMETRY_SQL = f"""WITH {sql.PRIMS} SELECT doc_id, primitive_id, round(greatest(x1 - x0, 0) * greatest(y1 - y0, 0), 6) AS area, round(least(greatest((x0 * 612 - 10) / 600.0, 0), 1), 6) AS clamped, CAST(round_even(x0 / 0.02, 0) AS INT) AS grid,
(0.05 <= x0 AND 0.05 <= y0 AND 0.95 >= x1 AND 0.95 >= y1) AS inside, round(greatest(least(x1, 0.5) - greatest(x0, 0), 0) * greatest(least(y1, 0.5) - greatest(y0, 0), 0), 6) AS overlap FROM p"""

QUERIES = {
    "furniture_candidates": (furniture_candidates, FURNITURE_SQL),
    "page_furniture": (page_furniture, PAGE_FURNITURE_SQL),
    "furniture_templates": (furniture_templates, TEMPLATES_SQL),
    "furniture_mask": (furniture_mask, MASK_SQL),
    "bands": (bands, BANDS_SQL),
    "merged_spans": (merged_spans, SPANS_SQL),
    "columns": (columns, COLUMNS_SQL),
    "regions": (regions, REGIONS_SQL),
    "region_edges": (region_edges, EDGES_SQL),
    "reading_order": (reading_order, ORDER_SQL),
    "unassigned_regions": (unassigned_regions, UNASSIGNED_SQL),
    "page_confidence": (page_confidence, CONFIDENCE_SQL),
    "asset_occurrences": (asset_occurrences, OCCURRENCES_SQL),
    "asset_classes": (asset_classes, CLASSES_SQL),
    "symbol_candidates": (symbol_candidates, SYMBOLS_SQL),
    "symbol_summary": (symbol_summary, SUMMARY_SQL),
    "symbol_hashes": (symbol_hashes, HASHES_SQL),
    "caption_scores": (caption_scores, SCORES_SQL),
    "caption_links": (caption_links, LINKS_SQL),
    "linked_blocks": (linked_blocks, LINKED_SQL),
    "sequential_links": (sequential_links, SEQUENTIAL_SQL),
    "callout_members": (callout_members, MEMBERS_SQL),
    "canonical_flags": (canonical_flags, FLAGS_SQL),
    "region_overlays": (region_overlays, OVERLAY_SQL),
    "wrapped_callouts": (wrapped_callouts, WRAPPED_SQL),
    "geometry": (geometry, GEOMETRY_SQL),
    "mixed_regions": (mixed_regions, MIXED_REGIONS_SQL),
    "mixed_order": (mixed_order, MIXED_ORDER_SQL),
    "mixed_confidence": (mixed_confidence, MIXED_CONFIDENCE_SQL),
}
