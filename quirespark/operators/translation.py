"""Planning of translation units, reuse of earlier translations, checks of responses and the merge back."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t
from ..functions.ids import fingerprint, inline_id, unit_id
from .packs import standing

MAX_NODES, CONTEXT_CHARS = 20, 200
# How tokens are estimated from characters.
CHARS_PER_TOKEN, SYSTEM_TOKENS, JSON_TOKENS, OUTPUT_RATIO = 4, 500, 80, 1.2
PAGE = ("doc_id", "page_number")


def in_scope(scope: Column, doc: Column) -> Column:
    """Whether a term of a pack applies to a document: an empty scope and ``*`` apply to all."""
    return scope.isNull() | (F.size(scope) == 0) | F.array_contains(scope, "*") | F.array_contains(scope, doc)


def style_hint(kind: Column) -> Column:
    return F.when(kind.isin("heading", "caption", "list"), kind).otherwise("paragraph")


def section_paths(page_blocks: DataFrame) -> DataFrame:
    """Adds ``section_path``: headings before a block; one of level 1 starts anew, others are appended, blank ones ignored."""
    before = Window.partitionBy(*PAGE).orderBy("block_ord").rowsBetween(Window.unboundedPreceding, -1)
    head = (F.col("kind") == "heading") & (F.trim("content") != "")
    top = head & (F.col("level") == 1)
    # The headings of a section are collected once for it; a block takes those that stand before it.
    marked = page_blocks.withColumns({"__top": F.last(F.when(top, F.col("content")), ignorenulls=True).over(before), "__sec": F.coalesce(F.count(F.when(top, 1)).over(before), F.lit(0))})
    section = Window.partitionBy(*PAGE, "__sec").orderBy("block_ord")
    heads = F.collect_list(F.when(head, F.col("content"))).over(section.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    seen = F.count(F.when(head, 1)).over(section.rowsBetween(Window.unboundedPreceding, -1)).cast("int")
    path = F.concat(F.array_compact(F.array("__top")), F.slice("__heads", F.lit(1), F.col("__seen")))
    return marked.withColumns({"__heads": heads, "__seen": F.coalesce(seen, F.lit(0))}).withColumn("section_path", path).drop("__top", "__sec", "__heads", "__seen")


def plan_units(page_blocks: DataFrame, max_nodes: int = MAX_NODES, context: int = CONTEXT_CHARS) -> DataFrame:
    """Translation units of each page.

    Headings, lists and standalone labels are units of their own, other blocks are
    packed in order, ``max_nodes`` at most (each yields one node, so that packing is
    arithmetic on row numbers).  ``doc_id, page_number, unit_id, block_ids,
    section_path, style_hint, nodes (array of inline_id, source_text),
    source_fingerprint, context_before, context_after``.
    """
    has = section_paths(page_blocks).where(F.trim(F.coalesce("content", F.lit(""))) != "")
    alone = F.col("kind").isin("heading", "list") | t.is_label(F.col("content"))
    w = Window.partitionBy(*PAGE).orderBy("block_ord")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = has.withColumn("__alone", alone.cast("int"))
    edge = F.when((F.col("__alone") == 1) | (F.coalesce(F.lag("__alone").over(w), F.lit(1)) == 1), 1).otherwise(0)
    isle = marked.withColumn("__edge", edge).withColumn("__isle", F.sum("__edge").over(upto))
    part = F.floor((F.row_number().over(Window.partitionBy(*PAGE, "__isle").orderBy("block_ord")) - 1) / max_nodes)
    parts = isle.withColumn("__part", part)
    node = F.struct("block_ord", "block_id", inline_id(F.col("block_id"), F.lit(0)).alias("inline_id"), F.col("content").alias("source_text"), "section_path", "kind")
    grouped = parts.groupBy(*PAGE, "__isle", "__part").agg(F.array_sort(F.collect_list(node)).alias("ns"))
    order = Window.partitionBy(*PAGE).orderBy("__isle", "__part")
    first = F.col("ns")[0]
    text = F.array_join(F.col("ns.source_text"), " ")
    units = grouped.withColumn("__text", text).select(
        *PAGE, unit_id(F.col("doc_id"), F.col("page_number"), F.row_number().over(order) - 1).alias("unit_id"), F.col("ns.block_id").alias("block_ids"),
        first["section_path"].alias("section_path"), style_hint(first["kind"]).alias("style_hint"),
        F.transform("ns", lambda x: F.struct(x["inline_id"].alias("inline_id"), x["source_text"].alias("source_text"))).alias("nodes"),
        fingerprint(F.col("__text")).alias("source_fingerprint"),
        F.coalesce(F.substring(F.lag("__text").over(order), 1, context), F.lit("")).alias("context_before"),
        F.coalesce(F.substring(F.lead("__text").over(order), 1, context), F.lit("")).alias("context_after"),
    )
    return units


def glossary_hints(units: DataFrame, terms: DataFrame, text: str = "source") -> DataFrame:
    """``unit_id, term_id``: terms whose name or alias stands in a unit's text, case aside.

    ``terms`` is a pack of fixed size (``term_id, en_canonical, en_aliases``); a
    unit and a term pair once.
    """
    names = terms.select("term_id", F.explode(F.array_distinct(F.concat(F.array("en_canonical"), F.coalesce("en_aliases", F.array().cast("array<string>"))))).alias("name")).where(F.length("name") > 0)
    low = names.select("term_id", F.lower("name").alias("name"))
    return standing(units.select("unit_id", F.lower(text).alias("__low")), "__low", low, "name").select("unit_id", "name").join(low, "name").select("unit_id", "term_id").distinct()


def estimate(units: DataFrame, input_price: float = 1.25, output_price: float = 10.0) -> DataFrame:
    """Tokens and cost of each document: needs ``doc_id, unit_id, source_chars, glossary_chars, context_chars, node_count``."""
    inp = F.floor((F.col("source_chars") + F.col("glossary_chars") + F.col("context_chars")) / CHARS_PER_TOKEN) + JSON_TOKENS + SYSTEM_TOKENS
    out = F.floor(F.col("source_chars") / CHARS_PER_TOKEN * OUTPUT_RATIO) + JSON_TOKENS
    total = units.withColumns({"__in": inp, "__out": out}).groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_units"), F.sum("node_count").alias("total_text_nodes"), F.sum("__in").alias("estimated_input_tokens"), F.sum("__out").alias("estimated_output_tokens"))
    cost = (F.col("estimated_input_tokens") * input_price + F.col("estimated_output_tokens") * output_price) / 1_000_000
    return total.withColumn("estimated_cost_usd", F.round(cost, 4))


def unit_sizes(units: DataFrame) -> DataFrame:
    """Characters of each unit as :func:`estimate` needs them, of a table with nodes, hints and contexts; repeated units count once."""
    add = lambda acc, x: acc + x
    chars = F.aggregate(F.transform("text_nodes", lambda n: F.coalesce(F.length(n["source_text"]), F.lit(0))), F.lit(0), add)
    gloss = F.aggregate(F.transform("glossary_subset", lambda h: F.coalesce(F.length(h["en"]), F.lit(0)) + F.coalesce(F.length(h["ru"]), F.lit(0)) + 10), F.lit(0), add)
    context = F.length(F.coalesce("context_before", F.lit(""))) + F.length(F.coalesce("context_after", F.lit("")))
    return units.select("doc_id", "unit_id", F.coalesce(chars, F.lit(0)).alias("source_chars"), F.coalesce(gloss, F.lit(0)).alias("glossary_chars"), context.alias("context_chars"), F.coalesce(F.size("text_nodes"), F.lit(0)).alias("node_count")).dropDuplicates(["unit_id"])


def memory_lookup(units: DataFrame, memory: DataFrame) -> DataFrame:
    """Units with the stored translations of their fingerprint, one after the other by node number; an empty fingerprint never matches.

    ``memory(source_fingerprint, translations array<string>)``.  Translations are
    put onto the unit's own nodes, so two units of one text both get theirs.
    """
    m = memory.select(F.col("source_fingerprint").alias("__fp"), "translations")
    hit = units.join(m, (F.col("source_fingerprint") == F.col("__fp")) & (F.col("source_fingerprint") != ""), "left")
    return hit.withColumn("cached", F.col("translations").isNotNull()).drop("__fp")


def memory_store(memory: DataFrame, results: DataFrame) -> DataFrame:
    """New rows for the memory: the first result of each fingerprint that translates anything and is not stored yet.

    ``results(source_fingerprint, unit_id, sources array<string>, translations array<string>)``.
    """
    useful = F.exists(F.zip_with("sources", "translations", lambda s, r: (F.coalesce(r, F.lit("")) != "") & ~r.eqNullSafe(s)), lambda x: F.coalesce(x, F.lit(False)))
    fresh = results.where((F.col("source_fingerprint") != "") & useful).groupBy("source_fingerprint").agg(F.min_by("translations", "unit_id").alias("translations"))
    return fresh.join(memory.select("source_fingerprint"), "source_fingerprint", "left_anti")


def merge_translations(inlines: DataFrame, units: DataFrame, results: DataFrame) -> DataFrame:
    """Inline rows with the translation of the last attempt for their node: adds ``translated``.

    ``inlines(unit key doc_id, page_number, inline_id, ...)``; units link a document
    to its results, of repeated results the last attempt (then time) wins, of units
    that hold the same node the later one (by its name); nodes without result keep NULL.
    """
    own = units.select("doc_id", "unit_id").distinct()
    last = results.groupBy("unit_id", "inline_id").agg(F.max_by("ru_text", F.struct("attempt", "finished_at", "ru_text")).alias("translated"))
    known = last.join(own, "unit_id").groupBy("doc_id", "inline_id").agg(F.max_by("translated", "unit_id").alias("translated"))
    return inlines.join(known, ["doc_id", "inline_id"], "left")


def lock_terms(text: Column, terms: list[str]) -> Column:
    """Locked terms become ``«PH_nn»``, longer ones first, case aside."""
    order = sorted(range(len(terms)), key=lambda k: (-len(terms[k]), k))
    for k in order:
        text = F.regexp_replace(text, F.lit("(?iu)\\Q" + terms[k].replace("\\E", "") + "\\E"), F.lit(f"«PH_{k:02d}»"))
    return text


def unlock_terms(text: Column, translations: list[str]) -> Column:
    for k, word in enumerate(translations):
        text = F.replace(text, F.lit(f"«PH_{k:02d}»"), F.lit(word))
    return text


def lost_placeholders(sent: Column, received: Column) -> Column:
    """Placeholders that were sent and did not come back."""
    pattern = F.lit("«PH_\\d{2}»")
    return F.array_sort(F.array_except(F.regexp_extract_all(sent, pattern, F.lit(0)), F.regexp_extract_all(received, pattern, F.lit(0))))


def parse_response(raw: Column) -> Column:
    """Translations of a response, as an array of ``inline_id, ru_text``; cut-off JSON is closed where possible."""
    schema = "struct<unit_id: string, translations: array<struct<inline_id: string, ru_text: string>>>"
    bare = F.rtrim(F.regexp_replace(raw, r"(?s)^.*?(?=\{)|```\s*$", ""))
    tries = [F.from_json(F.concat(bare, F.lit(end)), schema) for end in ("", "]}", '"}]}', "}]}")]
    out = tries[-1]["translations"]
    for x in reversed(tries[:-1]):
        out = F.when(x["translations"].isNotNull(), x["translations"]).otherwise(out)
    return out


def clean_output(raw: Column) -> Column:
    """Output of a command-line gateway without code fences and without the lines before its JSON."""
    lines = F.filter(F.split(raw, r"\r?\n"), lambda x: ~F.rlike(x, F.lit(r"^\s*```")))
    return F.trim(F.regexp_replace(F.array_join(lines, "\n"), r"(?s)^[^\[{]*(?=[\[{])", ""))


def user_prompt() -> Column:
    """A unit as the JSON that is sent: needs the columns of :func:`plan_units`."""
    return F.to_json(F.struct("unit_id", "section_path", "style_hint", "context_before", "context_after", F.col("nodes").alias("text_nodes")))


def with_fallback(*gateways: Callable[[str], str]) -> Callable[[str], str]:
    """A gateway that asks the next one where one fails; the last error is raised."""

    def call(text: str) -> str:
        for k, gateway in enumerate(gateways):
            try:
                return gateway(text)
            except Exception:  # noqa: BLE001
                if k == len(gateways) - 1:
                    raise
        raise ValueError("no gateway")

    return call


def locked_term_warnings(nodes: DataFrame, terms: DataFrame) -> DataFrame:
    """Nodes whose source holds a locked term and whose translation lacks its translation.

    ``nodes(unit_id, inline_id, source_text, ru_text)``; terms are a pack of fixed size.
    """
    locked = terms.where(F.col("lock_translation")).select("term_id", F.lower("en_canonical").alias("__en"), F.lower("ru_preferred").alias("__ru"))
    low = nodes.select("unit_id", "inline_id", F.lower("source_text").alias("__s"), F.lower("ru_text").alias("__t"))
    return standing(low, "__s", locked, "__en").join(locked, "__en").where(~F.contains(F.col("__t"), F.col("__ru"))).select("unit_id", "inline_id", "term_id")


def translate(units: DataFrame, gateway: Callable[[str], str] | None = None, attempts: int = 3) -> DataFrame:
    """Calls a gateway for each unit and node; up to ``attempts`` times, then the error is kept.

    ``unit_id, inline_id, ru_text, attempt, error``.  The default gateway is a
    deterministic stand-in.  Tasks may be repeated, so calls must be idempotent;
    results go to the memory with first-writer-wins.
    """
    call = gateway or (lambda s: "[RU] " + s)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for unit, inline, source in zip(part["unit_id"], part["inline_id"], part["source_text"]):
                text, error, n = None, None, 0
                while n < attempts and text is None:
                    n += 1
                    try:
                        text = call(source)
                    except Exception as e:  # noqa: BLE001
                        error = str(e)
                rows.append((unit, inline, text, n, None if text is not None else error))
            yield pd.DataFrame(rows, columns=["unit_id", "inline_id", "ru_text", "attempt", "error"])

    nodes = units.select("unit_id", F.explode("nodes").alias("n")).select("unit_id", F.col("n.inline_id").alias("inline_id"), F.col("n.source_text").alias("source_text"))
    return nodes.mapInPandas(run, "unit_id string, inline_id string, ru_text string, attempt int, error string")


def run_summary(results: DataFrame) -> DataFrame:
    """Completed, failed and cached nodes and the status of a run, as one row."""
    out = results.agg(F.count_if(F.col("ru_text").isNotNull()).alias("completed"), F.count_if(F.col("ru_text").isNull()).alias("failed"), F.count_if(F.coalesce("cached", F.lit(False))).alias("cached"))
    return out.withColumn("status", F.when(F.col("failed") == 0, "completed").when(F.col("completed") > 0, "partial").otherwise("failed"))


def glossary_links(runs: DataFrame, terms: DataFrame, first_only: bool = True) -> DataFrame:
    """Where terms stand in untranslated runs: longest form first, matches do not overlap.

    ``runs(doc_id, page_number, block_id, inline_id, node_ord, text, ru_text)``.
    With ``first_only`` the first occurrence of a term on a page counts.  The pack
    is of fixed size by contract: it is broadcast once and compiled once a task.
    """
    forms = F.concat(F.array("en_canonical", "ru_preferred"), F.coalesce("en_aliases", F.array().cast("array<string>")), F.coalesce("ru_variants", F.array().cast("array<string>")))
    flat = terms.select("term_id", F.explode(forms).alias("form")).where(F.length("form") > 0).distinct()
    pack = runs.sparkSession.sparkContext.broadcast(sorted((r["form"], r["term_id"]) for r in flat.collect()))
    names = ["doc_id", "page_number", "block_id", "node_ord", "inline_id"]
    todo = runs.where((F.length("text") > 0) & (F.coalesce("ru_text", F.lit("")) == "")).select(*names, "text")
    types = dict(todo.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[str, str] = {}
        for form, term in pack.value:
            first.setdefault(form.lower(), term)
        pattern = "|".join(re.escape(f) for f in sorted({f for f, _ in pack.value}, key=lambda f: (-len(f), f)))
        rx = re.compile(pattern, re.I)
        for batch in batches:
            rows, hits = [], []
            for k, text in enumerate(batch.column(5).to_pylist() if pattern else ()):
                for m in rx.finditer(text):
                    rows.append(k)
                    hits.append((first.get(m.group().lower()), m.start(), m.end()))
            own = batch.take(pa.array(rows, pa.int64()))
            terms_, starts, ends = zip(*hits) if hits else ((), (), ())
            yield pa.RecordBatch.from_arrays([*own.columns[:5], pa.array(terms_, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], [*names, "term_id", "start", "end"])

    out = todo.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in names) + ", term_id string, start int, end int")
    if first_only:
        w = Window.partitionBy("doc_id", "page_number", "term_id").orderBy("block_id", "node_ord", "inline_id", "start")
        out = out.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")
    return out


def with_glossary(units: DataFrame, hints: DataFrame, terms: DataFrame) -> DataFrame:
    """Units with ``text_nodes`` and ``glossary_subset``, the terms of :func:`glossary_hints`, as a gateway and :func:`unit_sizes` take them."""
    pack = terms.select("term_id", F.struct(F.col("en_canonical").alias("en"), F.col("ru_preferred").alias("ru"), F.col("lock_translation").alias("locked")).alias("__t"))
    own = hints.join(pack, "term_id").groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("term_id", "__t"))).alias("__ts"))
    subset = F.coalesce(F.transform("__ts", lambda x: x["__t"]), F.array().cast("array<struct<en: string, ru: string, locked: boolean>>"))
    return units.join(own, "unit_id", "left").withColumns({"text_nodes": F.col("nodes"), "glossary_subset": subset}).drop("__ts")


def translate_with_memory(units: DataFrame, memory: DataFrame, gateway: Callable[[str], str] | None = None) -> DataFrame:
    """:func:`translate` for units that the memory does not hold, with ``cached``; stored translations have attempt 0."""
    known = memory_lookup(units, memory)
    hits = known.where("cached").select("unit_id", F.posexplode("nodes").alias("k", "n"), "translations")
    stored = hits.select("unit_id", F.col("n.inline_id").alias("inline_id"), F.get("translations", F.col("k")).alias("ru_text"), F.lit(0).alias("attempt"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached"))
    return translate(known.where("not cached"), gateway).withColumn("cached", F.lit(False)).unionByName(stored)


def memory_rows(units: DataFrame, results: DataFrame) -> DataFrame:
    """Results as :func:`memory_store` takes them; units with a failed node are left out."""
    nodes = units.select("unit_id", "source_fingerprint", F.posexplode("nodes").alias("k", "n")).select("unit_id", "source_fingerprint", "k", F.col("n.inline_id").alias("inline_id"), F.col("n.source_text").alias("source"))
    both = nodes.join(results.select("unit_id", "inline_id", "ru_text"), ["unit_id", "inline_id"], "left")
    rows = both.groupBy("unit_id", "source_fingerprint").agg(F.array_sort(F.collect_list(F.struct("k", "source", "ru_text"))).alias("ns"), F.count_if(F.col("ru_text").isNull()).alias("lost")).where("lost = 0")
    return rows.select("source_fingerprint", "unit_id", F.col("ns.source").alias("sources"), F.col("ns.ru_text").alias("translations"))


def plan_summary(pages: DataFrame, units: DataFrame) -> DataFrame:
    """``doc_id, units, nodes, skipped_pages`` of each document of ``pages(doc_id, page_number, route)``; pages shown as an image are skipped."""
    own = units.groupBy("doc_id").agg(F.count(F.lit(1)).alias("units"), F.sum(F.size("nodes")).alias("nodes"))
    every = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("route") == "facsimile", F.col("page_number")))).alias("skipped_pages"))
    return every.join(own, "doc_id", "left").select("doc_id", F.coalesce("units", F.lit(0)).alias("units"), F.coalesce("nodes", F.lit(0)).alias("nodes"), "skipped_pages")
