"""Queries on translation units, the memory, navigation, search, quality and the public bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import bundle, enrich, layout, quality, structure, translation
from ..sources.tables import table
from ..streaming import events
from . import sql
from .layout_queries import _pictures
from .text_queries import prims


def page_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Headings of the navigation and texts of the runs as ordered blocks of pages."""
    runs = table(spark, d, "inline_nodes").where("kind = 'text'").select("doc_id", "page_number", "block_id", "node_ord", "inline_id", "text").distinct()
    nav = table(spark, d, "navigation").select("doc_id", "page_number", "anchor_id", "nav_level", "label_en").distinct()
    a = nav.select("doc_id", "page_number", F.col("anchor_id").alias("block_id"), F.lit("heading").alias("kind"), F.col("nav_level").alias("level"), F.col("label_en").alias("content"), F.lit(0).alias("src"), F.col("anchor_id").alias("k1"), F.lit(0).alias("k2"))
    b = runs.select("doc_id", "page_number", F.col("inline_id").alias("block_id"), F.lit("paragraph").alias("kind"), F.lit(None).cast("int").alias("level"), F.col("text").alias("content"), F.lit(1).alias("src"), F.col("block_id").alias("k1"), F.col("node_ord").alias("k2"))
    w = Window.partitionBy("doc_id", "page_number").orderBy("src", "k1", "k2", "block_id")
    return a.unionByName(b).withColumn("block_ord", F.row_number().over(w) - 1).drop("src", "k1", "k2")


def section_paths(spark: SparkSession, d: str) -> DataFrame:
    """Section path of each entry of the navigation, whose books stand for pages here."""
    nav = table(spark, d, "navigation").select("doc_id", "page_number", "anchor_id", "nav_level", "label_en").distinct()
    w = Window.partitionBy("doc_id").orderBy("page_number", "anchor_id")
    blocks = nav.select("doc_id", F.lit(1).alias("page_number"), F.col("anchor_id").alias("block_id"), F.lit("heading").alias("kind"), F.col("nav_level").alias("level"), F.coalesce("label_en", F.lit("")).alias("content"), (F.row_number().over(w) - 1).alias("block_ord"))
    return translation.section_paths(blocks).select("doc_id", "block_id", F.array_join("section_path", " > ").alias("section_path"))


PATHS_SQL = """WITH n AS (SELECT DISTINCT doc_id, page_number, anchor_id, nav_level, label_en FROM navigation),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, anchor_id) AS k FROM n),
t AS (SELECT o.doc_id, o.anchor_id, o.k, coalesce((SELECT max(i.k) FROM o i WHERE i.doc_id = o.doc_id AND i.k < o.k AND i.nav_level = 1 AND trim(coalesce(i.label_en, '')) <> ''), 0) AS top FROM o)
SELECT t.doc_id, t.anchor_id AS block_id, coalesce((SELECT string_agg(i.label_en, ' > ' ORDER BY i.k) FROM o i WHERE i.doc_id = t.doc_id AND i.k < t.k AND i.k >= t.top AND trim(coalesce(i.label_en, '')) <> ''), '') AS section_path FROM t"""


def planned_units(spark: SparkSession, d: str) -> DataFrame:
    u = translation.plan_units(page_blocks(spark, d), max_nodes=3)
    return u.select("doc_id", "page_number", "unit_id", "style_hint", F.array_join("block_ids", ",").alias("block_ids"), F.array_join("section_path", " > ").alias("section_path"), F.array_join(F.transform("nodes", lambda n: n["source_text"]), " ").alias("source"), "source_fingerprint", "context_before", "context_after")


UNITS_SQL = f"""WITH {sql.BLOCKS}, h AS (SELECT *, CASE WHEN kind = 'heading' OR {sql.label('content')} THEN 1 ELSE 0 END AS alone FROM pb WHERE trim(coalesce(content, '')) <> ''),
e AS (SELECT *, CASE WHEN alone = 1 OR coalesce(lag(alone) OVER (PARTITION BY doc_id, page_number ORDER BY block_ord), 1) = 1 THEN 1 ELSE 0 END AS edge FROM h),
i AS (SELECT *, sum(edge) OVER (PARTITION BY doc_id, page_number ORDER BY block_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isle FROM e),
q AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, page_number, isle ORDER BY block_ord) - 1) // 3 AS part FROM i),
s AS (SELECT q.*, coalesce((SELECT string_agg(x.content, ' > ' ORDER BY x.block_ord) FROM pb x WHERE x.doc_id = q.doc_id AND x.page_number = q.page_number AND x.kind = 'heading' AND x.block_ord < q.block_ord AND trim(coalesce(x.content, '')) <> ''
  AND x.block_ord >= coalesce((SELECT max(y.block_ord) FROM pb y WHERE y.doc_id = q.doc_id AND y.page_number = q.page_number AND y.kind = 'heading' AND y.level = 1 AND y.block_ord < q.block_ord AND trim(coalesce(y.content, '')) <> ''), 0)), '') AS path FROM q),
g AS (SELECT doc_id, page_number, isle, part, string_agg(block_id, ',' ORDER BY block_ord) AS block_ids, string_agg(content, ' ' ORDER BY block_ord) AS source, arg_min(kind, block_ord) AS kind, arg_min(path, block_ord) AS section_path FROM s GROUP BY ALL)
SELECT doc_id, page_number, printf('%s:u%04d_%02d', doc_id, page_number, row_number() OVER w - 1) AS unit_id, CASE WHEN kind = 'heading' THEN 'heading' ELSE 'paragraph' END AS style_hint, block_ids, section_path, source, substr(sha256(source), 1, 16) AS source_fingerprint,
coalesce(substr(lag(source) OVER w, 1, 200), '') AS context_before, coalesce(substr(lead(source) OVER w, 1, 200), '') AS context_after FROM g WINDOW w AS (PARTITION BY doc_id, page_number ORDER BY isle, part)"""


def _unit_texts(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "translation_units")
    return u.select("doc_id", "unit_id", "source_fingerprint", F.array_join(F.transform("text_nodes", lambda n: F.coalesce(n["source_text"], F.lit(""))), " ").alias("source")).distinct()


_UT = "ut AS (SELECT DISTINCT doc_id, unit_id, source_fingerprint, array_to_string(list_transform(text_nodes, lambda n: coalesce(n.source_text, '')), ' ') AS source FROM translation_units)"


def glossary_hints(spark: SparkSession, d: str) -> DataFrame:
    return translation.glossary_hints(_unit_texts(spark, d), table(spark, d, "glossary_terms"))


HINTS_SQL = f"""WITH {_UT}, t AS (SELECT DISTINCT term_id, lower(unnest(list_concat([en_canonical], coalesce(en_aliases, [])))) AS name FROM glossary_terms)
SELECT DISTINCT unit_id, term_id FROM ut JOIN t ON contains(lower(source), name) WHERE name <> ''"""


def cost_by_book(spark: SparkSession, d: str) -> DataFrame:
    return translation.estimate(translation.unit_sizes(table(spark, d, "translation_units")))


COST_SQL = """WITH u AS (SELECT DISTINCT doc_id, unit_id, coalesce(list_sum(list_transform(text_nodes, lambda n: coalesce(length(n.source_text), 0))), 0) AS s, coalesce(list_sum(list_transform(glossary_subset, lambda h: coalesce(length(h.en), 0) + coalesce(length(h.ru), 0) + 10)), 0) AS g,
 length(coalesce(context_before, '')) + length(coalesce(context_after, '')) AS c, coalesce(len(text_nodes), 0) AS n FROM translation_units),
t AS (SELECT doc_id, count(*) AS total_units, CAST(sum(n) AS BIGINT) AS total_text_nodes, CAST(sum(floor((s + g + c) / 4) + 580) AS BIGINT) AS i, CAST(sum(floor(s / 4 * 1.2) + 80) AS BIGINT) AS o FROM u GROUP BY doc_id)
SELECT doc_id, total_units, total_text_nodes, i AS estimated_input_tokens, o AS estimated_output_tokens, round((i * 1.25 + o * 10.0) / 1000000, 4) AS estimated_cost_usd FROM t"""


def _last_answers(spark: SparkSession, d: str) -> DataFrame:
    """The answer of the last attempt for each node; of repeated ones the latest."""
    return table(spark, d, "translated_nodes").groupBy("unit_id", "inline_id").agg(F.max_by("ru_text", F.struct("attempt", "finished_at", "ru_text")).alias("ru_text"))


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Last attempts of each unit in the order of its nodes."""
    nodes = table(spark, d, "translation_units").select("unit_id", "source_fingerprint", F.posexplode("text_nodes").alias("n", "node")).select("unit_id", "source_fingerprint", "n", F.col("node.inline_id").alias("inline_id"), F.col("node.source_text").alias("s")).distinct()
    first = _last_answers(spark, d).withColumnRenamed("ru_text", "r")
    row = F.array_sort(F.collect_list(F.struct("n", F.coalesce("s", F.lit("")).alias("s"), F.coalesce("r", F.lit("")).alias("r"))))
    return nodes.join(first, ["unit_id", "inline_id"], "left").groupBy("unit_id", "source_fingerprint").agg(row.alias("rows")).select("unit_id", "source_fingerprint", F.col("rows.s").alias("sources"), F.col("rows.r").alias("translations"))


_RES = """nd AS (SELECT DISTINCT unit_id, source_fingerprint, unnest(range(0, len(text_nodes))) AS n, unnest(text_nodes) AS node FROM translation_units),
fa AS (SELECT unit_id, inline_id, ru_text AS r FROM (SELECT *, row_number() OVER (PARTITION BY unit_id, inline_id ORDER BY attempt DESC, finished_at DESC NULLS LAST, ru_text DESC NULLS LAST) AS k FROM translated_nodes) WHERE k = 1),
rs AS (SELECT nd.unit_id, nd.source_fingerprint, list(coalesce(nd.node.source_text, '') ORDER BY n) AS sources, list(coalesce(fa.r, '') ORDER BY n) AS translations, bool_or(coalesce(fa.r, '') <> '' AND coalesce(fa.r, '') <> coalesce(nd.node.source_text, '')) AS useful
 FROM nd LEFT JOIN fa ON fa.unit_id = nd.unit_id AND fa.inline_id = nd.node.inline_id GROUP BY nd.unit_id, nd.source_fingerprint),
tm AS (SELECT source_fingerprint, arg_min(translations, unit_id) AS translations FROM rs WHERE useful AND source_fingerprint <> '' GROUP BY 1)"""


def _empty_memory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "source_fingerprint string, translations array<string>")


def memory_store(spark: SparkSession, d: str) -> DataFrame:
    return translation.memory_store(_empty_memory(spark), _results(spark, d)).withColumn("translations", F.array_join("translations", " | "))


STORE_SQL = f"WITH {_RES} SELECT source_fingerprint, array_to_string(translations, ' | ') AS translations FROM tm"


def memory_lookup(spark: SparkSession, d: str) -> DataFrame:
    memory = translation.memory_store(_empty_memory(spark), _results(spark, d))
    return translation.memory_lookup(_unit_texts(spark, d), memory).select("unit_id", "cached", F.coalesce(F.size("translations"), F.lit(0)).alias("nodes"))


LOOKUP_SQL = f"WITH {_RES}, {_UT} SELECT unit_id, tm.translations IS NOT NULL AS cached, CAST(coalesce(len(tm.translations), 0) AS INT) AS nodes FROM ut LEFT JOIN tm ON tm.source_fingerprint = ut.source_fingerprint AND ut.source_fingerprint <> ''"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "inline_nodes").where("kind = 'text'").select("doc_id", "page_number", "block_id", "node_ord", "inline_id", "text", "ru_text").distinct()


_RUNS = "rn AS (SELECT DISTINCT doc_id, page_number, block_id, node_ord, inline_id, text, ru_text FROM inline_nodes WHERE kind = 'text')"


def merged_translations(spark: SparkSession, d: str) -> DataFrame:
    return translation.merge_translations(_runs(spark, d), table(spark, d, "translation_units"), table(spark, d, "translated_nodes")).select("doc_id", "inline_id", "text", "translated")


MERGE_SQL = f"""WITH {_RUNS}, l AS (SELECT unit_id, inline_id, arg_max(ru_text, {{'a': attempt, 'b': finished_at, 'c': ru_text}}) AS translated FROM (SELECT * FROM translated_nodes WHERE ru_text IS NOT NULL) GROUP BY ALL),
m AS (SELECT unit_id, inline_id, max({{'a': attempt, 'b': finished_at}}) AS last FROM translated_nodes GROUP BY ALL),
f AS (SELECT t.unit_id, t.inline_id, max(t.ru_text) AS translated FROM translated_nodes t JOIN m ON m.unit_id = t.unit_id AND m.inline_id = t.inline_id AND m.last = {{'a': t.attempt, 'b': t.finished_at}} GROUP BY ALL),
k AS (SELECT u.doc_id, f.inline_id, arg_max(f.translated, u.unit_id) AS translated FROM f JOIN (SELECT DISTINCT doc_id, unit_id FROM translation_units) u USING (unit_id) GROUP BY ALL)
SELECT rn.doc_id, rn.inline_id, rn.text, k.translated FROM rn LEFT JOIN k USING (doc_id, inline_id)"""


def coverage(spark: SparkSession, d: str) -> DataFrame:
    return enrich.coverage(_runs(spark, d)).withColumn("coverage", F.round("coverage", 6))


COVERAGE_SQL = f"""WITH {_RUNS} SELECT doc_id, count(*) FILTER (trim(coalesce(text, '')) <> '') AS texts, count(*) FILTER (trim(coalesce(text, '')) <> '' AND coalesce(ru_text, '') <> '') AS translated,
round(CASE WHEN count(*) FILTER (trim(coalesce(text, '')) <> '') > 0 THEN count(*) FILTER (trim(coalesce(text, '')) <> '' AND coalesce(ru_text, '') <> '') / count(*) FILTER (trim(coalesce(text, '')) <> '') ELSE 0.0 END, 6) AS coverage FROM rn GROUP BY doc_id"""


def _node_pairs(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "translation_units").select("unit_id", F.explode("text_nodes").alias("n")).select("unit_id", F.col("n.inline_id").alias("inline_id"), F.col("n.source_text").alias("source_text")).distinct()
    return nodes.join(_last_answers(spark, d), ["unit_id", "inline_id"])


_NP = "np AS (SELECT DISTINCT n.unit_id, n.inline_id, n.source_text, t.ru_text FROM (SELECT DISTINCT unit_id, x.inline_id AS inline_id, x.source_text AS source_text FROM (SELECT unit_id, unnest(text_nodes) AS x FROM translation_units)) n JOIN (SELECT unit_id, inline_id, ru_text FROM (SELECT *, row_number() OVER (PARTITION BY unit_id, inline_id ORDER BY attempt DESC, finished_at DESC NULLS LAST, ru_text DESC NULLS LAST) AS k FROM translated_nodes) WHERE k = 1) t USING (unit_id, inline_id))"


def locked_terms(spark: SparkSession, d: str) -> DataFrame:
    return translation.locked_term_warnings(_node_pairs(spark, d), table(spark, d, "glossary_terms"))


LOCKED_SQL = f"WITH {_NP} SELECT unit_id, inline_id, term_id FROM np JOIN glossary_terms g ON g.lock_translation AND contains(lower(source_text), lower(en_canonical)) AND NOT contains(lower(ru_text), lower(ru_preferred))"

LOCKED = ["storm die", "threat deck", "moon card"]


def placeholders(spark: SparkSession, d: str) -> DataFrame:
    """Texts with locked terms as placeholders, and with them back; what was lost on a way that drops the second one."""
    c = translation.lock_terms(F.col("source_text"), LOCKED)
    n = _node_pairs(spark, d).where(F.col("source_text").isNotNull()).select("unit_id", "inline_id", "source_text").distinct().withColumn("locked", c)
    lost = translation.lost_placeholders(F.col("locked"), F.replace(F.col("locked"), F.lit("«PH_01»"), F.lit("")))
    return n.select("unit_id", "inline_id", "locked", translation.unlock_terms(F.col("locked"), ["кубик бури", "колода угроз", "карта луны"]).alias("unlocked"), F.array_join(lost, ",").alias("lost"))


_LK = "regexp_replace(regexp_replace(regexp_replace(source_text, 'threat deck', '«PH_01»', 'gi'), 'storm die', '«PH_00»', 'gi'), 'moon card', '«PH_02»', 'gi')"
PLACEHOLDERS_SQL = f"""WITH {_NP}, k AS (SELECT DISTINCT unit_id, inline_id, {_LK} AS locked FROM np WHERE source_text IS NOT NULL)
SELECT unit_id, inline_id, locked, replace(replace(replace(locked, '«PH_00»', 'кубик бури'), '«PH_01»', 'колода угроз'), '«PH_02»', 'карта луны') AS unlocked, CASE WHEN contains(locked, '«PH_01»') THEN '«PH_01»' ELSE '' END AS lost FROM k"""


def parsed_responses(spark: SparkSession, d: str) -> DataFrame:
    """Responses of units as JSON, every third of them cut off at its end, parsed back with all their texts."""
    r = _results(spark, d).withColumn("t", F.transform("translations", lambda x, i: F.struct(F.concat(F.lit("i"), i.cast("string")).alias("inline_id"), x.alias("ru_text"))))
    raw = F.to_json(F.struct("unit_id", F.col("t").alias("translations")))
    cut = F.when(F.pmod(F.xxhash64("unit_id"), F.lit(3)) == 0, F.substring(raw, 1, F.length(raw) - 2)).otherwise(raw)
    texts = F.array_join(F.transform(translation.parse_response(cut), lambda x: F.concat(x["inline_id"], F.lit("="), x["ru_text"])), " | ")
    return r.select("unit_id", "source_fingerprint", texts.alias("texts"))


PARSED_SQL = f"WITH {_RES} SELECT unit_id, source_fingerprint, coalesce(array_to_string([('i' || (i - 1) || '=' || translations[i]) for i in range(1, len(translations) + 1)], ' | '), '') AS texts FROM rs"


def glossary_links(spark: SparkSession, d: str) -> DataFrame:
    return translation.glossary_links(_runs(spark, d), table(spark, d, "glossary_terms"))


LINKS_SQL = f"""WITH RECURSIVE {_RUNS}, fm AS (SELECT DISTINCT term_id, unnest(list_concat([en_canonical, ru_preferred], coalesce(en_aliases, []), coalesce(ru_variants, []))) AS form FROM glossary_terms),
ff AS (SELECT lower(form) AS low, arg_min(term_id, {{'a': form, 'b': term_id}}) AS term_id FROM fm WHERE form <> '' GROUP BY 1),
rx AS (SELECT '(?i)(?:' || string_agg(regexp_escape(form), '|' ORDER BY length(form) DESC, form) || ')' AS rx FROM (SELECT DISTINCT form FROM fm WHERE form <> '')),
td AS (SELECT * FROM rn WHERE length(text) > 0 AND coalesce(ru_text, '') = ''),
st AS (SELECT doc_id, page_number, block_id, node_ord, inline_id, 0::BIGINT AS off, text AS rest, regexp_extract(text, rx) AS m, rx FROM td, rx
 UNION ALL SELECT doc_id, page_number, block_id, node_ord, inline_id, off + instr(rest, m) - 1 + length(m), substr(rest, instr(rest, m) + length(m)), regexp_extract(substr(rest, instr(rest, m) + length(m)), rx), rx FROM st WHERE m <> ''),
ht AS (SELECT st.*, ff.term_id, CAST(off + instr(rest, m) - 1 AS INT) AS a FROM st LEFT JOIN ff ON ff.low = lower(m) WHERE m <> ''),
nb AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number, term_id ORDER BY block_id, node_ord, inline_id, a) AS k FROM ht)
SELECT doc_id, page_number, block_id, node_ord, inline_id, term_id, a AS start, CAST(a + length(m) AS INT) AS "end" FROM nb WHERE k = 1"""


def translated_units(spark: SparkSession, d: str) -> DataFrame:
    """Planned units through the stand-in gateway."""
    return translation.translate(translation.plan_units(page_blocks(spark, d)))


TRANSLATED_SQL = UNITS_SQL.replace("// 3 AS part", f"// {translation.MAX_NODES} AS part").rsplit("SELECT doc_id, page_number, printf", 1)[0] + """, un AS (SELECT doc_id, page_number, isle, part, printf('%s:u%04d_%02d', doc_id, page_number, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY isle, part) - 1) AS unit_id FROM g)
SELECT un.unit_id, printf('%s:i%03d', s.block_id, 0) AS inline_id, '[RU] ' || s.content AS ru_text, 1 AS attempt, NULL::VARCHAR AS error FROM s JOIN un ON un.doc_id = s.doc_id AND un.page_number = s.page_number AND un.isle = s.isle AND un.part = s.part"""


def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return translation.run_summary(table(spark, d, "translated_nodes").distinct())


RUN_SQL = """WITH t AS (SELECT DISTINCT * FROM translated_nodes), n AS (SELECT count(*) FILTER (ru_text IS NOT NULL) AS completed, count(*) FILTER (ru_text IS NULL) AS failed, count(*) FILTER (cached) AS cached FROM t)
SELECT *, CASE WHEN failed = 0 THEN 'completed' WHEN completed > 0 THEN 'partial' ELSE 'failed' END AS status FROM n"""


def navigation_tree(spark: SparkSession, d: str) -> DataFrame:
    return enrich.nest(table(spark, d, "navigation").select("doc_id", "page_number", "anchor_id", "nav_level").distinct())


NAV_SQL = """WITH n AS (SELECT DISTINCT doc_id, page_number, anchor_id, nav_level FROM navigation)
SELECT doc_id, page_number, anchor_id, nav_level, CASE WHEN nav_level > 1 THEN last_value(CASE WHEN nav_level = 1 THEN anchor_id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_number, anchor_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS parent FROM n"""


def navigation_entries(spark: SparkSession, d: str) -> DataFrame:
    return enrich.navigation(page_blocks(spark, d))


ENTRIES_SQL = f"""WITH {sql.BLOCKS}, n AS (SELECT doc_id, page_number, block_id AS anchor_id, content AS label, coalesce(level, 2) AS nav_level FROM pb WHERE kind = 'heading' AND NOT (contains(content, '....') OR contains(content, '…')))
SELECT *, CASE WHEN nav_level > 1 THEN last_value(CASE WHEN nav_level = 1 THEN anchor_id END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_number, anchor_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS parent FROM n"""


def search_documents(spark: SparkSession, d: str) -> DataFrame:
    return enrich.search_documents(page_blocks(spark, d)).withColumn("section_path", F.array_join("section_path", " > "))


_SD = f"""{sql.BLOCKS}, s AS (SELECT *, last_value(CASE WHEN kind = 'heading' THEN content END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_number, block_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading,
 sum(CASE WHEN kind = 'heading' AND level = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number ORDER BY block_ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sec FROM pb),
sd AS (SELECT s.doc_id, s.page_number, s.block_id, s.kind, s.content, s.heading, coalesce((SELECT string_agg(x.content, ' > ' ORDER BY x.block_ord) FROM s x WHERE x.doc_id = s.doc_id AND x.page_number = s.page_number AND x.sec = s.sec AND x.kind = 'heading' AND x.block_ord <= s.block_ord), '') AS section_path
 FROM s WHERE trim(coalesce(content, '')) <> '')"""
SEARCH_SQL = f"WITH {_SD} SELECT * FROM sd"


def index_manifest(spark: SparkSession, d: str) -> DataFrame:
    return enrich.index_manifest(enrich.search_documents(page_blocks(spark, d)))


MANIFEST_SQL = f"WITH {_SD}, k AS (SELECT doc_id, kind, count(*) AS n FROM sd GROUP BY ALL) SELECT k.doc_id, string_agg(kind || '=' || n, ',' ORDER BY kind) AS kinds, CAST(sum(n) AS BIGINT) AS total, (SELECT count(DISTINCT page_number) FROM sd WHERE sd.doc_id = k.doc_id) AS pages FROM k GROUP BY k.doc_id"


def search(spark: SparkSession, d: str) -> DataFrame:
    """Ten best blocks for two words (a top-k report)."""
    return enrich.search(enrich.search_documents(page_blocks(spark, d)), "storm lantern").withColumn("score", F.round("score", 6))


FOUND_SQL = f"""WITH {_SD}, k AS (SELECT block_id AS key, list_filter(string_split_regex(lower(content), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS toks FROM sd),
st AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM k), e AS (SELECT key, len(toks) AS len, unnest(toks) AS w FROM k),
h AS (SELECT key, len, w, count(*) AS tf FROM e WHERE w IN ('storm', 'lantern') GROUP BY ALL), f AS (SELECT w, count(*) AS df FROM h GROUP BY w)
SELECT key, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score FROM h JOIN f USING (w), st GROUP BY key ORDER BY score DESC, key LIMIT 10"""


def quality_issues(spark: SparkSession, d: str) -> DataFrame:
    return quality.with_ids(_issues(spark, d))


def _issues(spark: SparkSession, d: str) -> DataFrame:
    r = _runs(spark, d)
    return quality.missing_translation(r).unionByName(quality.empty_translation(r))


_IS = f"""{_RUNS}, iss AS (SELECT 'translation.missing' AS rule_id, 'warning' AS severity, 'translation' AS category, doc_id, page_number, inline_id AS item, 'no translation' AS message FROM rn WHERE trim(coalesce(text, '')) <> '' AND coalesce(ru_text, '') = ''
 UNION ALL SELECT 'translation.empty', 'error', 'translation', doc_id, page_number, inline_id, 'blank translation' FROM rn WHERE ru_text IS NOT NULL AND trim(ru_text) = '')"""
ISSUES_SQL = f"WITH {_IS} SELECT *, 'qa-' || substr(sha256(concat_ws(':', rule_id, severity, message, 'p' || page_number, item)), 1, 12) AS issue_id FROM iss"


def quality_by_category(spark: SparkSession, d: str) -> DataFrame:
    return quality.by_category(_issues(spark, d))


CATEGORY_SQL = f"WITH {_IS} SELECT category, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'info') AS infos FROM iss GROUP BY category"


def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    return quality.gate(_issues(spark, d))


GATE_SQL = f"WITH {_IS}, n AS (SELECT count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM iss) SELECT *, errors <= 0 AND warnings <= 50 AS accepted FROM n"


def graph_issues(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the region graph and reading order of which the entries of the second band were lost."""
    r = layout.regions(prims(spark, d))
    order = layout.reading_order(r).where("band_index <> 1")
    return quality.region_graph(r, layout.edges(r)).unionByName(quality.order_checks(r, order))


GRAPH_SQL = f"""WITH {sql.ORDER}, lo AS (SELECT * FROM o WHERE band_index <> 1), g AS (SELECT doc_id, page_number FROM lo GROUP BY ALL HAVING min(sequence_index) <> 0 OR max(sequence_index) <> count(*) - 1 OR count(DISTINCT sequence_index) <> count(*))
SELECT 'extraction.reading_order' AS rule_id, 'error' AS severity, 'extraction' AS category, doc_id, page_number, 'order' AS item, 'sequence is not contiguous' AS message FROM g
UNION ALL SELECT 'extraction.reading_order', 'warning', 'extraction', doc_id, page_number, region_id, 'region is not in the order' FROM (SELECT *, max(CASE WHEN kind_hint = 'column' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_number, band_index) = 1 AS has_columns FROM r) r WHERE NOT EXISTS (SELECT 1 FROM lo WHERE lo.doc_id = r.doc_id AND lo.page_number = r.page_number AND lo.region_id = r.region_id) AND NOT (kind_hint = 'band' AND has_columns)"""


def _planted(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Tables of pages with one defect or another in each, made from places of blocks so that every rule has something to say."""
    w = Window.partitionBy("doc_id", "page_number").orderBy("block_ord")
    o, n = F.col("block_ord"), F.col("page_number")
    b = page_blocks(spark, d).withColumns({"after": F.lead("block_id").over(w), "before": F.lag("block_id").over(w)}).where(F.col("page_number").isNotNull())
    kind = F.when(o % 5 == 0, "figure").when(o % 5 == 1, "caption").when(o % 5 == 2, "callout").otherwise("paragraph")
    caption = F.when((o % 5 == 0) & (o % 2 == 0), F.col("after")).when(o % 5 == 0, F.concat("block_id", F.lit(":gone")))
    parent = F.when((o % 5 == 1) & (o % 3 == 0), F.col("after")).when((o % 5 == 1) & (o % 3 == 1), F.col("before")).when(o % 5 == 1, "none")
    blocks = b.select("doc_id", "page_number", "block_id", kind.alias("kind"), F.when(o % 2 == 1, F.col("content")).alias("content"), caption.alias("caption_block_id"), parent.alias("parent_block_id"))
    cell = lambda r, c: F.struct(r.cast("int").alias("row"), F.lit(c).alias("col"))
    tables = b.where(o % 7 == 3).select("doc_id", "page_number", "block_id", (o % 3 + 1).alias("rows"), F.lit(2).alias("cols"), F.when(n % 2 == 1, F.array(cell(F.lit(0), 0), cell(o % 4, 1))).alias("cells"))
    regions = b.select("doc_id", "page_number", F.col("block_id").alias("region_id"), F.lit("band").alias("kind_hint"), o.alias("band_index"))
    edges = b.select("doc_id", "page_number", F.col("block_id").alias("src"), F.when(o % 6 == 5, F.col("block_id")).when(o % 6 == 4, "nowhere").otherwise(F.coalesce("after", "block_id")).alias("dst"))
    order = regions.where(F.col("band_index") % 4 != 3).select("doc_id", "page_number", F.when(F.col("band_index") % 6 == 2, F.concat("region_id", F.lit(":x"))).otherwise(F.col("region_id")).alias("region_id"), F.col("band_index").alias("sequence_index"))
    route = F.when(n % 3 == 0, "hybrid").when(n % 3 == 1, "facsimile").otherwise("semantic")
    symbols = b.select("doc_id", "page_number", F.col("block_id").alias("primitive_id"), F.when(o % 4 == 0, "").when(o % 4 == 2, "  ").when(o % 4 == 3, "sym.x").alias("symbol_id"))
    return {"blocks": blocks, "tables": tables, "regions": regions.unionByName(regions.where("band_index % 6 = 3")), "edges": edges, "reading_order": order, "pages": b.select("doc_id", "page_number", route.alias("route")).distinct(), "symbols": symbols, "runs": _runs(spark, d)}


def rule_issues(spark: SparkSession, d: str) -> DataFrame:
    """All nine rules over pages with planted defects."""
    return quality.evaluate(_planted(spark, d))


RULES_SQL = f"""WITH {_IS}, {sql.BLOCKS},
b AS (SELECT *, lead(block_id) OVER w AS after, lag(block_id) OVER w AS before FROM pb WINDOW w AS (PARTITION BY doc_id, page_number ORDER BY block_ord)),
k AS (SELECT doc_id, page_number, block_id, block_ord AS o, CASE o % 5 WHEN 0 THEN 'figure' WHEN 1 THEN 'caption' WHEN 2 THEN 'callout' ELSE 'paragraph' END AS kind, CASE WHEN o % 2 = 1 THEN content END AS content, after,
 CASE WHEN o % 5 = 0 THEN CASE WHEN o % 2 = 0 THEN after ELSE block_id || ':gone' END END AS cap, CASE WHEN o % 5 = 1 THEN CASE o % 3 WHEN 0 THEN after WHEN 1 THEN before ELSE 'none' END END AS par FROM b WHERE page_number IS NOT NULL),
tb AS (SELECT doc_id, page_number, block_id, o % 3 + 1 AS rows_, CASE WHEN page_number % 2 = 1 THEN [{{'r': 0, 'c': 0}}, {{'r': o % 4, 'c': 1}}] ELSE [] END AS cells FROM k WHERE o % 7 = 3),
ed AS (SELECT doc_id, page_number, block_id AS src, CASE WHEN o % 6 = 5 THEN block_id WHEN o % 6 = 4 THEN 'nowhere' ELSE coalesce(after, block_id) END AS dst FROM k),
od AS (SELECT doc_id, page_number, CASE WHEN o % 6 = 2 THEN block_id || ':x' ELSE block_id END AS region_id, o FROM k WHERE o % 4 <> 3),
q(rule_id, severity, category, doc_id, page_number, item, message) AS (SELECT rule_id, severity, category, doc_id, page_number, item, message FROM iss
 UNION ALL SELECT DISTINCT 'confidence.low_page', CASE page_number % 3 WHEN 0 THEN 'warning' ELSE 'info' END, 'confidence', doc_id, page_number, CASE page_number % 3 WHEN 0 THEN 'hybrid' ELSE 'facsimile' END, 'page is not rendered semantically' FROM k WHERE page_number % 3 < 2
 UNION ALL SELECT 'entity.figure_caption_linkage', 'error', 'entity', doc_id, page_number, block_id, 'caption does not exist' FROM k WHERE cap IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k x WHERE x.doc_id = k.doc_id AND x.page_number = k.page_number AND x.block_id = k.cap)
 UNION ALL SELECT 'entity.figure_caption_linkage', 'error', 'entity', doc_id, page_number, block_id, 'parent does not exist' FROM k WHERE par IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k x WHERE x.doc_id = k.doc_id AND x.page_number = k.page_number AND x.block_id = k.par)
 UNION ALL SELECT 'entity.figure_caption_linkage', 'error', 'entity', k.doc_id, k.page_number, k.block_id, 'parent is neither figure nor table' FROM k JOIN k x ON x.doc_id = k.doc_id AND x.page_number = k.page_number AND x.block_id = k.par WHERE x.kind NOT IN ('figure', 'table')
 UNION ALL SELECT 'entity.table_structure', 'error', 'entity', doc_id, page_number, block_id, 'dimensions without cells' FROM tb WHERE len(cells) = 0
 UNION ALL SELECT 'entity.table_structure', 'error', 'entity', doc_id, page_number, block_id, 'cell out of bounds' FROM (SELECT *, unnest(cells) AS c FROM tb) WHERE c.r >= rows_ OR c.c >= 2
 UNION ALL SELECT 'entity.callout_structure', 'warning', 'entity', doc_id, page_number, block_id, 'callout without content' FROM k WHERE kind = 'callout' AND coalesce(content, '') = ''
 UNION ALL SELECT 'extraction.region_graph', 'error', 'extraction', doc_id, page_number, block_id, 'region id is not unique' FROM k WHERE o % 6 = 3
 UNION ALL SELECT 'extraction.region_graph', 'error', 'extraction', doc_id, page_number, dst, 'dst of an edge does not exist' FROM ed WHERE dst = 'nowhere'
 UNION ALL SELECT 'extraction.region_graph', 'error', 'extraction', doc_id, page_number, src, 'edge onto itself' FROM ed WHERE src = dst
 UNION ALL SELECT 'extraction.reading_order', 'error', 'extraction', doc_id, page_number, 'order', 'sequence is not contiguous' FROM od GROUP BY ALL HAVING min(o) <> 0 OR max(o) <> count(*) - 1 OR count(DISTINCT o) <> count(*)
 UNION ALL SELECT 'extraction.reading_order', 'error', 'extraction', doc_id, page_number, region_id, 'unknown region' FROM od WHERE o % 6 = 2
 UNION ALL SELECT 'extraction.reading_order', 'warning', 'extraction', doc_id, page_number, block_id, 'region is not in the order' FROM k WHERE o % 4 = 3 OR o % 6 = 2
 UNION ALL SELECT 'extraction.reading_order', 'warning', 'extraction', doc_id, page_number, block_id, 'region is not in the order' FROM k WHERE o % 6 = 3 AND o % 4 = 3
 UNION ALL SELECT 'symbol.anchor_validity', 'error', 'symbol', doc_id, page_number, block_id, 'symbol without id' FROM k WHERE o % 4 < 3)
SELECT *, 'qa-' || substr(sha256(concat_ws(':', rule_id, severity, message, 'p' || page_number, item)), 1, 12) AS issue_id FROM q"""


def glossary_drawer(spark: SparkSession, d: str) -> DataFrame:
    """References with their term, unknown terms without."""
    refs = table(spark, d, "inline_nodes").where("kind = 'glossary_ref'").select("doc_id", "inline_id", "term_id", "surface_form").distinct()
    terms = table(spark, d, "glossary_terms").select("term_id", "en_canonical", "ru_preferred")
    return refs.join(terms, "term_id", "left").select("doc_id", "inline_id", bundle.pick(F.coalesce("surface_form", F.lit("")), F.col("ru_preferred"), "ru").alias("shown"), F.col("en_canonical").isNotNull().alias("known"))


DRAWER_SQL = """WITH r AS (SELECT DISTINCT doc_id, inline_id, term_id, surface_form FROM inline_nodes WHERE kind = 'glossary_ref')
SELECT doc_id, inline_id, coalesce(nullif(ru_preferred, ''), coalesce(surface_form, '')) AS shown, en_canonical IS NOT NULL AS known FROM r LEFT JOIN glossary_terms g USING (term_id)"""


def spaced_text(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "inline_nodes").select("doc_id", "block_id", "node_ord", "inline_id", F.coalesce("text", "surface_form").alias("text")).distinct()
    return bundle.spaced_text(n, ["doc_id", "block_id"], ["node_ord", "inline_id"])


SPACED_SQL = """WITH n AS (SELECT DISTINCT doc_id, block_id, node_ord, inline_id, coalesce(text, surface_form, '') AS t FROM inline_nodes), l AS (SELECT *, lag(t) OVER (PARTITION BY doc_id, block_id ORDER BY node_ord, inline_id) AS p FROM n),
s AS (SELECT doc_id, block_id, node_ord, inline_id, CASE WHEN p IS NULL OR p = '' OR t = '' OR regexp_matches(p, '\\s$') OR regexp_matches(t, '^\\s') THEN '' ELSE ' ' END || t AS t FROM l)
SELECT doc_id, block_id, string_agg(t, '' ORDER BY node_ord, inline_id) AS text FROM s GROUP BY ALL"""


def _books(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "doc_summaries").select("doc_id", F.coalesce("title_en", F.lit("")).alias("title"), "page_count").distinct()


def routes(spark: SparkSession, d: str) -> DataFrame:
    return bundle.routes(_books(spark, d))


ROUTES_SQL = """WITH b AS (SELECT DISTINCT doc_id, page_count FROM doc_summaries WHERE page_count > 0), p AS (SELECT doc_id, page_count, unnest(range(1, page_count + 1)) AS n FROM b)
SELECT doc_id, CAST(n AS INT) AS page_number, '/docs/' || doc_id || '/page/' || n AS route, CAST(CASE WHEN n > 1 THEN n - 1 END AS INT) AS prev_page, CAST(CASE WHEN n < page_count THEN n + 1 END AS INT) AS next_page FROM p"""


def catalog_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Books with a cost estimate replace their catalog row; those of one name pattern are taken out."""
    new = table(spark, d, "cost_estimates").groupBy("doc_id").agg(F.max("run_id").alias("title"), F.max("total_units").alias("page_count")).withColumn("include_in_catalog", ~F.endswith("doc_id", F.lit("3")))
    return bundle.upsert_catalog(_books(spark, d), new)


UPSERT_SQL = """WITH b AS (SELECT DISTINCT doc_id, coalesce(title_en, '') AS title, page_count FROM doc_summaries), n AS (SELECT doc_id, max(run_id) AS title, max(total_units) AS page_count FROM cost_estimates GROUP BY doc_id)
SELECT * FROM b WHERE doc_id NOT IN (SELECT doc_id FROM n) UNION ALL SELECT * FROM n WHERE NOT ends_with(doc_id, '3')"""


def patched_blocks(spark: SparkSession, d: str) -> DataFrame:
    patches = spark.createDataFrame([(0, None, "sec-0001", "override_block_kind", "paragraph"), (1, 4, "sec-0004", "replace_text", "patched"), (2, 99, "sec-0001", "replace_text", "never"), (3, None, "sec-0001", "unknown", "x"), (4, 4, "sec-0004", "replace_text", "patched again")], "patch_ord int, target_page int, target_block_id string, action string, value string")
    return structure.apply_patches(page_blocks(spark, d), patches).select("doc_id", "page_number", "block_id", "kind", "level", "content")


PATCH_SQL = f"""WITH {sql.BLOCKS} SELECT doc_id, page_number, block_id, CASE WHEN block_id = 'sec-0001' THEN 'paragraph' ELSE kind END AS kind, CASE WHEN block_id = 'sec-0001' THEN NULL ELSE level END AS level,
CASE WHEN block_id = 'sec-0004' AND page_number = 4 THEN 'patched again' WHEN block_id = 'sec-0001' AND page_number = 99 THEN 'never' ELSE content END AS content FROM pb"""


def table_grid(spark: SparkSession, d: str) -> DataFrame:
    """Texts of a page as cells of a grid of three columns."""
    cells = prims(spark, d).select("doc_id", "page_number", F.floor(F.col("prim_ord") / 3).cast("int").alias("row"), (F.col("prim_ord") % 3).alias("col"), F.coalesce("text", F.lit("")).alias("text"), F.col("primitive_id").alias("cell_ord"))
    return bundle.table_grid(cells, ["doc_id", "page_number"], 3)


GRID_SQL = f"""WITH {sql.PRIMS} SELECT doc_id, page_number, CAST(prim_ord // 3 AS INT) AS row, {', '.join(f"coalesce(arg_max(coalesce(text, ''), primitive_id) FILTER (prim_ord % 3 = {k}), '') AS c{k}" for k in range(3))} FROM p GROUP BY ALL"""


def public_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pictures as public blocks with paths to their assets."""
    p = _pictures(spark, d).select("doc_id", "page_number", F.col("prim_ord").alias("block_ord"), F.col("primitive_id").alias("block_id"), F.lit("figure").alias("kind"), F.lit(None).cast("int").alias("level"), F.lit("").alias("content"), F.concat(F.substring("content_hash", 1, 8), F.lit(".png")).alias("asset_ref"), F.lit(1).alias("internal"))
    return bundle.public_blocks(p).select("doc_id", "page_number", "block_id", "asset_ref")


PUBLIC_SQL = """WITH a AS (SELECT DISTINCT doc_id, candidate_id, content_hash, page_numbers FROM furniture_profile WHERE source_primitive_kind = 'image'), b AS (SELECT doc_id, candidate_id, content_hash, unnest(page_numbers) AS page_number FROM a)
SELECT doc_id, page_number, candidate_id || '@' || page_number AS block_id, CASE WHEN content_hash IS NOT NULL THEN '/assets/' || doc_id || '/' || substr(content_hash, 1, 8) || '.png' END AS asset_ref FROM b"""


def contents(spark: SparkSession, d: str) -> DataFrame:
    return bundle.contents(navigation_tree(spark, d)).withColumn("path", F.array_join("path", "/"))


CONTENTS_SQL = NAV_SQL.replace("SELECT doc_id, page_number, anchor_id, nav_level, CASE", ", t AS (SELECT doc_id, page_number, anchor_id, nav_level, CASE", 1) + """)
SELECT doc_id, anchor_id, page_number, coalesce(parent || '/', '') || anchor_id AS path, CASE WHEN parent IS NULL THEN 1 ELSE 2 END AS depth FROM t"""


def block_html(spark: SparkSession, d: str) -> DataFrame:
    return bundle.html(page_blocks(spark, d)).select("doc_id", "page_number", "block_id", "html", bundle.render_mode(F.lit("semantic"), F.col("kind")).alias("mode"))


_SAFE = "replace(replace(replace(coalesce(content, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
HTML_SQL = f"""WITH {sql.BLOCKS} SELECT doc_id, page_number, block_id, CASE WHEN kind = 'heading' THEN '<h' || least(coalesce(level, 2), 6) || '>' || {_SAFE} || '</h' || least(coalesce(level, 2), 6) || '>' ELSE '<p>' || {_SAFE} || '</p>' END AS html,
CASE WHEN kind = 'heading' THEN 'heading' ELSE 'text' END AS mode FROM pb"""


def split_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Runs cut at the first storm and lantern."""
    parts = structure.split_symbols(_runs(spark, d).where(F.col("text").isNotNull()), [("sym.storm", "storm"), ("sym.lantern", "lantern")])
    return parts.select("doc_id", "inline_id", F.array_join(F.transform("parts", lambda p: F.concat(F.left(p["kind"], F.lit(1)), F.lit(":"), p["value"])), "|").alias("parts"))


def _cut(s: str, symbol: str, token: str) -> str:
    """SQL of one step of the split: ``s`` is a pair of what is done and what is left."""
    return f"list_transform([{s}], lambda q: CASE WHEN instr(q[2], '{token}') > 0 THEN [q[1] || CASE WHEN instr(q[2], '{token}') > 1 THEN '|t:' || left(q[2], CAST(instr(q[2], '{token}') - 1 AS INT)) ELSE '' END || '|s:{symbol}', substr(q[2], instr(q[2], '{token}') + {len(token)})] ELSE q END)[1]"


SPLIT_SQL = f"""WITH {_RUNS}, s AS (SELECT doc_id, inline_id, {_cut(_cut("['', text]", 'sym.storm', 'storm'), 'sym.lantern', 'lantern')} AS s FROM rn WHERE text IS NOT NULL)
SELECT doc_id, inline_id, substr(s[1] || CASE WHEN s[2] <> '' THEN '|t:' || s[2] ELSE '' END, 2) AS parts FROM s"""


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and hour (an extension; the same function serves the stream)."""
    return events.hourly(table(spark, d, "events"))


EVENTS_SQL = "SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL"

QUERIES = {
    "section_paths": (section_paths, PATHS_SQL),
    "planned_units": (planned_units, UNITS_SQL),
    "glossary_hints": (glossary_hints, HINTS_SQL),
    "cost_by_book": (cost_by_book, COST_SQL),
    "memory_store": (memory_store, STORE_SQL),
    "memory_lookup": (memory_lookup, LOOKUP_SQL),
    "merged_translations": (merged_translations, MERGE_SQL),
    "coverage": (coverage, COVERAGE_SQL),
    "locked_terms": (locked_terms, LOCKED_SQL),
    "placeholders": (placeholders, PLACEHOLDERS_SQL),
    "parsed_responses": (parsed_responses, PARSED_SQL),
    "glossary_links": (glossary_links, LINKS_SQL),
    "translated_units": (translated_units, TRANSLATED_SQL),
    "run_summary": (run_summary, RUN_SQL),
    "navigation_tree": (navigation_tree, NAV_SQL),
    "navigation_entries": (navigation_entries, ENTRIES_SQL),
    "search_documents": (search_documents, SEARCH_SQL),
    "index_manifest": (index_manifest, MANIFEST_SQL),
    "search": (search, FOUND_SQL),
    "quality_issues": (quality_issues, ISSUES_SQL),
    "quality_by_category": (quality_by_category, CATEGORY_SQL),
    "quality_gate": (quality_gate, GATE_SQL),
    "graph_issues": (graph_issues, GRAPH_SQL),
    "rule_issues": (rule_issues, RULES_SQL),
    "glossary_drawer": (glossary_drawer, DRAWER_SQL),
    "spaced_text": (spaced_text, SPACED_SQL),
    "routes": (routes, ROUTES_SQL),
    "catalog_upsert": (catalog_upsert, UPSERT_SQL),
    "patched_blocks": (patched_blocks, PATCH_SQL),
    "table_grid": (table_grid, GRID_SQL),
    "public_pages": (public_pages, PUBLIC_SQL),
    "contents": (contents, CONTENTS_SQL),
    "block_html": (block_html, HTML_SQL),
    "split_symbols": (split_symbols, SPLIT_SQL),
    "event_windows": (event_windows, EVENTS_SQL),
}
