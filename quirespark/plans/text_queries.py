"""Queries on texts: normal forms, predicates, blocks and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as t
from ..operators import primitives, structure
from ..session import spread
from ..sources.tables import table
from . import sql


def prims(spark: SparkSession, d: str) -> DataFrame:
    return primitives.from_text_table(table(spark, d, "text_primitives"))


def cost_estimate_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Dry-run cost of each source: lines without noise, packed twenty to a unit within a document."""
    docs = spread(table(spark, d, "documents").select("source", "text"))
    # A document is one row: its lines are chosen, cut into units and added up inside of it, and only sums are exchanged.
    kept = F.filter(F.transform(F.split("text", "\n", -1), lambda x: t.squeeze(x)), lambda x: ~t.is_noise(x))
    sizes = docs.select("source", F.explode(F.array(F.transform(kept, lambda x: F.length(x)))).alias("sizes")).where(F.size("sizes") > 0)
    unit = lambda u: F.aggregate(F.slice("sizes", u * UNIT_LINES + 1, UNIT_LINES), F.lit(0), lambda a, x: a + x)
    chars = F.transform(F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / UNIT_LINES).cast("int")), unit)
    units = sizes.select("source", F.size("sizes").alias("nodes"), F.explode(F.array(chars)).alias("chars"))
    total = lambda f: F.aggregate(F.transform("chars", f), F.lit(0).cast("bigint"), lambda a, x: a + x)
    inp, out = total(lambda c: F.floor(c / 4) + 580), total(lambda c: F.floor(c / 4 * 1.2) + 80)
    return units.groupBy("source").agg(F.sum(F.size("chars")).alias("units"), F.sum("nodes").alias("nodes"), F.sum(inp).alias("input_tokens"), F.sum(out).alias("output_tokens"))


#: Lines of a document that make a unit.
UNIT_LINES = 20

COST_SQL = f"""WITH l AS (SELECT source, doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
k AS (SELECT source, doc_id, pos, {sql.squeeze('line')} AS line FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn FROM k WHERE NOT {sql.noise('line')}),
u AS (SELECT source, doc_id, (rn - 1) // 20 AS unit, sum(length(line)) AS chars, count(*) AS nodes FROM n GROUP BY ALL)
SELECT source, count(*) AS units, CAST(sum(nodes) AS BIGINT) AS nodes, CAST(sum(floor(chars / 4) + 580) AS BIGINT) AS input_tokens, CAST(sum(floor(chars / 4 * 1.2) + 80) AS BIGINT) AS output_tokens FROM u GROUP BY source"""


def text_predicates(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    flags = {"noise": t.is_noise(c), "label": t.is_label(c), "caption": t.is_caption(c), "contents": t.is_contents_entry(c), "header": t.is_page_header(c), "number": t.is_page_number(c), "dingbat": t.has_dingbat(c), "goes_on": t.continues(c)}
    return prims(spark, d).select("doc_id", "primitive_id", *[F.coalesce(v, F.lit(False)).alias(k) for k, v in flags.items()])


_T = sql.squeeze("coalesce(text, '')")
PREDICATES_SQL = f"""WITH {sql.PRIMS} SELECT doc_id, primitive_id, {sql.noise('text')} AS noise, {sql.label('text')} AS label, coalesce(regexp_matches(lower(trim(text)), '^(figure |fig\\. |fig |table |diagram )'), FALSE) AS caption,
coalesce(contains(text, '....') OR contains(text, '…'), FALSE) AS contents, coalesce(regexp_matches(text, '^\\d{{1,3}}\\s*[A-Z]'), FALSE) AS header, coalesce(regexp_matches(text, '^\\s*(?:\\d{{1,4}}|[ivxlcdm]{{1,8}}|[IVXLCDM]{{1,8}})\\s*$'), FALSE) AS number,
coalesce(regexp_matches(text, '{sql.DINGBAT}'), FALSE) AS dingbat,
({_T} = '' OR (NOT {sql.label('text')} AND (length({_T}) < 10 OR right({_T}, 1) = '-' OR regexp_matches({_T}, '^\\p{{Ll}}') OR NOT contains('.!?:;)"''', right({_T}, 1))))) AS goes_on FROM p"""


def text_normalized(spark: SparkSession, d: str) -> DataFrame:
    c = t.normalized(F.col("text"))
    return prims(spark, d).where(F.col("text").isNotNull()).select("doc_id", "primitive_id", c.alias("clean"), t.bullet(c).alias("bullet"), t.without_bullet(c).alias("rest"), t.without_page_number(c).alias("unnumbered"), t.font_family(F.coalesce("font_name", F.lit(""))).alias("family"))


_C = f"{sql.squeeze(sql.undecorate('v'))}"
NORMALIZED_SQL = f"""WITH {sql.PRIMS}, v AS (SELECT doc_id, primitive_id, font_name, {sql.plain('nfc_normalize(text)')} AS v FROM p WHERE text IS NOT NULL), c AS (SELECT *, {_C} AS clean FROM v),
b AS (SELECT *, CASE WHEN starts_with(clean, '•') THEN '•' WHEN starts_with(clean, '–') THEN '–' WHEN starts_with(clean, '-') THEN '-' WHEN starts_with(clean, '▶') THEN '▶' ELSE '' END AS bullet FROM c)
SELECT doc_id, primitive_id, clean, bullet, CASE WHEN bullet = '' THEN clean ELSE ltrim(substr(clean, length(bullet) + 1)) END AS rest, regexp_replace(clean, '^\\d{{1,3}}\\s*([A-Z])', '\\1') AS unnumbered, string_split(coalesce(font_name, ''), '-')[1] AS family FROM b"""


def body_font_size(spark: SparkSession, d: str) -> DataFrame:
    return structure.body_sizes(prims(spark, d))


BODY_SQL = f"""WITH {sql.PRIMS}, n AS (SELECT doc_id, font_size, count(*) AS n, min({{'a': page_number, 'b': prim_ord, 'c': primitive_id}}) AS f FROM p WHERE font_size IS NOT NULL GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS k FROM n) SELECT doc_id, font_size AS body_size FROM k WHERE k = 1"""


def block_kinds(spark: SparkSession, d: str) -> DataFrame:
    return structure.classify(prims(spark, d)).select("doc_id", "primitive_id", "clean", "kind_hint")


_K = sql.squeeze(sql.undecorate("v"))
_CLASS = f"""{sql.PRIMS}, n AS (SELECT doc_id, font_size, count(*) AS n, min({{'a': page_number, 'b': prim_ord, 'c': primitive_id}}) AS f FROM p WHERE font_size IS NOT NULL GROUP BY ALL),
body AS (SELECT doc_id, font_size AS body_size FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS k FROM n) WHERE k = 1),
v AS (SELECT p.*, coalesce(body_size, 11.0) AS body_size, {sql.plain("coalesce(text, '')")} AS v FROM p LEFT JOIN body USING (doc_id)), w AS (SELECT *, {_K} AS clean FROM v),
cls AS (SELECT *, CASE WHEN {sql.noise('clean')} OR regexp_matches(clean, '^\\d{{1,3}}\\s*[A-Z]') THEN 'skip' WHEN regexp_matches(clean, '^[•–▶-]') THEN 'list_item'
 WHEN length(trim(clean)) BETWEEN 3 AND 200 AND body_size > 0 AND NOT regexp_matches(trim(clean), '^\\d+$') AND coalesce(font_size, 0) >= body_size * 1.15 THEN 'heading'
 WHEN regexp_matches(lower(trim(clean)), '^(figure |fig\\. |fig |table |diagram )') THEN 'caption' ELSE 'paragraph' END AS kind_hint FROM w)"""
KINDS_SQL = f"WITH {_CLASS} SELECT doc_id, primitive_id, clean, kind_hint FROM cls"


def list_runs(spark: SparkSession, d: str) -> DataFrame:
    return structure.list_runs(structure.classify(prims(spark, d))).select("doc_id", "page_number", "first_ord", F.array_join("items", " | ").alias("items"))


_RUNS = f"""{_CLASS}, k1 AS (SELECT *, lag(kind_hint) OVER (PARTITION BY doc_id, page_number ORDER BY prim_ord, primitive_id) AS pk FROM cls WHERE kind_hint <> 'skip'),
k2 AS (SELECT *, sum(CASE WHEN kind_hint = 'list_item' AND coalesce(pk, '') <> 'list_item' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number ORDER BY prim_ord, primitive_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM k1)"""
RUNS_SQL = f"""WITH {_RUNS} SELECT doc_id, page_number, min(prim_ord) AS first_ord, string_agg(ltrim(substr(clean, 2)), ' | ' ORDER BY prim_ord, primitive_id) AS items FROM k2 WHERE kind_hint = 'list_item' GROUP BY doc_id, page_number, run"""


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return structure.blocks(structure.classify(prims(spark, d)))


BLOCKS_SQL = f"""WITH {_RUNS}, a AS (SELECT doc_id, page_number, min(prim_ord) AS ord, 'list' AS kind, CAST(NULL AS INT) AS level, string_agg(ltrim(substr(clean, 2)), chr(10) ORDER BY prim_ord, primitive_id) AS content FROM k2 WHERE kind_hint = 'list_item' GROUP BY doc_id, page_number, run
 UNION ALL SELECT doc_id, page_number, prim_ord, kind_hint, CASE WHEN kind_hint = 'heading' THEN CASE WHEN font_size >= 1.5 * body_size THEN 1 ELSE 2 END END, clean FROM cls WHERE kind_hint IN ('heading', 'caption', 'paragraph')),
b AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY ord, kind, content) - 1 AS INT) AS block_ord FROM a)
SELECT doc_id, page_number, kind, level, content, block_ord, printf('%s:p%04d:b%03d:%s', doc_id, page_number, block_ord, kind) AS block_id FROM b"""


def merged_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return structure.merge_paragraphs(blocks(spark, d))


#: A paragraph goes on in the next one of its run while all that was joined so far is unfinished.
MERGED_SQL = BLOCKS_SQL.replace("WITH ", "WITH RECURSIVE ", 1).rsplit("SELECT doc_id, page_number, kind", 1)[0] + f""", r AS (SELECT *, sum(CASE WHEN kind <> 'paragraph' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number ORDER BY block_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM b),
q AS (SELECT doc_id, page_number, run, block_ord, content, row_number() OVER (PARTITION BY doc_id, page_number, run ORDER BY block_ord) AS n FROM r WHERE kind = 'paragraph'),
f AS (SELECT doc_id, page_number, run, n, block_ord, content FROM q WHERE n = 1
 UNION ALL SELECT q.doc_id, q.page_number, q.run, q.n, CASE WHEN {sql.goes_on('f.content')} THEN f.block_ord ELSE q.block_ord END, CASE WHEN {sql.goes_on('f.content')} THEN f.content || ' ' || q.content ELSE q.content END
 FROM f JOIN q ON q.doc_id = f.doc_id AND q.page_number = f.page_number AND q.run = f.run AND q.n = f.n + 1)
SELECT doc_id, page_number, block_ord, arg_max(content, n) AS content FROM f GROUP BY doc_id, page_number, run, block_ord"""


def merged_runs(spark: SparkSession, d: str) -> DataFrame:
    """Texts of a page as spans of one block: neighbours of one style are joined."""
    spans = prims(spark, d).select(ids.page_id(F.col("doc_id"), F.col("page_number")).alias("block_id"), F.col("prim_ord").alias("span_ord"), F.coalesce("text", F.lit("")).alias("text"), "font_name", "font_size", "is_bold", "is_italic")
    return structure.merge_runs(spans)


MERGED_RUNS_SQL = f"""WITH {sql.PRIMS}, s AS (SELECT printf('%s:p%04d', doc_id, page_number) AS block_id, prim_ord, coalesce(text, '') AS text, font_size, string_split(coalesce(font_name, ''), '-')[1] AS f, coalesce(is_bold, FALSE) AS b, coalesce(is_italic, FALSE) AS i FROM p),
k AS (SELECT *, CASE WHEN lag({{'f': f, 'b': b, 'i': i}}) OVER (PARTITION BY block_id ORDER BY prim_ord) = {{'f': f, 'b': b, 'i': i}} THEN 0 ELSE 1 END AS nw FROM s),
r AS (SELECT *, sum(nw) OVER (PARTITION BY block_id ORDER BY prim_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS run FROM k)
SELECT block_id, CAST(run AS BIGINT) AS run_ord, string_agg(text, '' ORDER BY prim_ord) AS text, max(font_size) AS font_size, f AS font_family, b AS is_bold, i AS is_italic FROM r GROUP BY block_id, run, f, b, i"""


def joined_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each document as one text without what a line repeats of the end of the last."""
    lines = spread(table(spark, d, "documents").where(F.length("text") > 0).select("doc_id", "text")).select("doc_id", F.split(t.compose("text"), r"\r?\n", -1).alias("lines"))
    return lines.select("doc_id", structure.join_lines(F.col("lines")).alias("text"))


_LAST = "chr(1114109)"
_LINE = sql.squeeze(sql.undecorate(sql.plain("l")))
JOINED_SQL = f"""WITH l AS (SELECT doc_id, unnest(string_split_regex(nfc_normalize(text), '\r?\n')) AS l, unnest(range(0, len(string_split_regex(nfc_normalize(text), '\r?\n')))) AS i FROM documents WHERE length(text) > 0),
c AS (SELECT doc_id, i, {_LINE} AS x FROM l), g AS (SELECT doc_id, list(x ORDER BY i) FILTER (x <> '') AS xs FROM c GROUP BY doc_id),
r AS (SELECT doc_id, CASE WHEN len(xs) > 0 THEN list_reduce(xs, lambda acc, x: list_transform([string_split(acc, {_LAST})], lambda a:
 list_transform([coalesce(list_max(list_filter(range(1, least(length(a[-1]), length(x)) + 1), lambda k: right(a[-1], CAST(k AS INT)) = left(x, CAST(k AS INT)))), 0)], lambda m:
 CASE WHEN m <= 2 THEN acc || {_LAST} || x WHEN ltrim(substr(x, CAST(m AS INT) + 1)) = '' THEN acc ELSE acc || ' ' || ltrim(substr(x, CAST(m AS INT) + 1)) END)[1])[1]) ELSE '' END AS v FROM g),
j AS (SELECT doc_id, replace(v, {_LAST}, ' ') AS v FROM r) SELECT doc_id, {sql.squeeze(sql.undecorate('v'))} AS text FROM j"""


def repeated_phrases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", structure.without_repeats(F.col("text")).alias("text"))


PHRASES_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '{sql.SPACE.replace(']+', chr(92) + 'x{001C}-' + chr(92) + 'x{001F}]+')}'), lambda x: x <> '') AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM w WHERE len(w) > 1),
m AS (SELECT doc_id, k, CASE WHEN k + 7 <= len(w) AND w[k] = w[k + 4] AND w[k:k + 3] = w[k + 4:k + 7] THEN 4 WHEN k + 5 <= len(w) AND w[k] = w[k + 3] AND w[k:k + 2] = w[k + 3:k + 5] THEN 3
 WHEN k + 3 <= len(w) AND w[k] = w[k + 2] AND w[k:k + 1] = w[k + 2:k + 3] THEN 2 WHEN k + 1 <= len(w) AND w[k] = w[k + 1] THEN 1 ELSE 0 END AS n FROM e),
c AS (SELECT doc_id, k, n, k + 2 * n AS after FROM m WHERE n > 0), x AS (SELECT a.doc_id, a.k, a.n, b.k AS following FROM c a ASOF LEFT JOIN c b ON a.doc_id = b.doc_id AND a.after <= b.k),
t AS (SELECT x.* FROM x JOIN (SELECT doc_id, min(k) AS k FROM c GROUP BY doc_id) f USING (doc_id, k) UNION ALL SELECT x.* FROM t JOIN x ON x.doc_id = t.doc_id AND x.k = t.following),
gone AS (SELECT doc_id, unnest(range(k + n, k + 2 * n)) AS k FROM t),
s AS (SELECT e.doc_id, string_agg(e.w[e.k], ' ' ORDER BY e.k) AS text FROM e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.k = e.k WHERE gone.k IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CASE WHEN len(w.w) > 1 THEN s.text ELSE w.text END AS text FROM w LEFT JOIN s ON s.doc_id = w.doc_id"""


def readable_ids(spark: SparkSession, d: str) -> DataFrame:
    p = prims(spark, d)
    doc, page, n = F.col("doc_id"), F.col("page_number"), F.col("prim_ord")
    block = ids.block_id(doc, page, n, F.lit("text"))
    return p.select(
        "primitive_id", ids.page_id(doc, page).alias("page_id"), block.alias("block_id"), ids.list_item_id(doc, page, n, n).alias("item_id"), ids.unit_id(doc, page, n).alias("unit_id"), ids.inline_id(block, n).alias("inline_id"),
        ids.asset_occurrence_id(ids.asset_class_id(F.lit("raster"), n), page, n).alias("occurrence_id"), ids.primitive_id(F.lit("text"), page, n).alias("own_id"), ids.symbol_candidate_id(page, n).alias("symbol_id"),
        ids.fingerprint(F.coalesce("text", F.lit(""))).alias("fingerprint"), ids.release_id(F.lit("run"), doc).alias("release_id"), ids.cache_key({"doc": doc, "page": page}).alias("cache_key"),
        ids.issue_id(F.lit("rule"), F.lit("error"), F.lit("message"), page, F.lit(None).cast("string")).alias("issue_id"),
    )


IDS_SQL = f"""WITH {sql.PRIMS} SELECT primitive_id, printf('%s:p%04d', doc_id, page_number) AS page_id, printf('%s:p%04d:b%03d:text', doc_id, page_number, prim_ord) AS block_id, printf('%s:p%04d:b%03d:li%02d', doc_id, page_number, prim_ord, prim_ord) AS item_id,
printf('%s:u%04d_%02d', doc_id, page_number, prim_ord) AS unit_id, printf('%s:p%04d:b%03d:text:i%03d', doc_id, page_number, prim_ord, prim_ord) AS inline_id, printf('asset:raster:%03d:p%04d:%02d', prim_ord, page_number, prim_ord) AS occurrence_id,
printf('text:p%04d:%03d', page_number, prim_ord) AS own_id, printf('sym:p%04d:%03d', page_number, prim_ord) AS symbol_id, substr(sha256(coalesce(text, '')), 1, 16) AS fingerprint, 'rel-' || substr(sha256('run:' || doc_id), 1, 12) AS release_id,
sha256('doc=' || doc_id || '|page=' || page_number) AS cache_key, 'qa-' || substr(sha256('rule:error:message:p' || page_number), 1, 12) AS issue_id FROM p"""


def slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "navigation").select("doc_id", "anchor_id", t.slug("label_en").alias("slug")).distinct()


SLUGS_SQL = """WITH n AS (SELECT DISTINCT doc_id, anchor_id, label_en FROM navigation), b AS (SELECT *, regexp_replace(lower(regexp_replace(strip_accents(label_en), '[^\\x{00}-\\x{7F}]', '', 'g')), '[^\\w\\s-]', '', 'g') AS b FROM n)
SELECT DISTINCT doc_id, anchor_id, CASE WHEN label_en IS NOT NULL THEN coalesce(nullif(left(trim(regexp_replace(b, '[-\\s]+', '-', 'g'), '-'), 60), ''), 'anchor') END AS slug FROM b"""

QUERIES = {
    "cost_estimate_by_source": (cost_estimate_by_source, COST_SQL),
    "text_predicates": (text_predicates, PREDICATES_SQL),
    "text_normalized": (text_normalized, NORMALIZED_SQL),
    "body_font_size": (body_font_size, BODY_SQL),
    "block_kinds": (block_kinds, KINDS_SQL),
    "list_runs": (list_runs, RUNS_SQL),
    "blocks": (blocks, BLOCKS_SQL),
    "merged_paragraphs": (merged_paragraphs, MERGED_SQL),
    "merged_runs": (merged_runs, MERGED_RUNS_SQL),
    "joined_lines": (joined_lines, JOINED_SQL),
    "repeated_phrases": (repeated_phrases, PHRASES_SQL),
    "readable_ids": (readable_ids, IDS_SQL),
    "slugs": (slugs, SLUGS_SQL),
}
