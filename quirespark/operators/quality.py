"""Quality rules.  A rule takes tables and returns issues: ``rule_id, severity, category, doc_id, page_number, item, message``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import issue_id
from . import layout


def _issue(df: DataFrame, rule: str, severity, category: str, item: str, message) -> DataFrame:
    s = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(F.lit(rule).alias("rule_id"), s.alias("severity"), F.lit(category).alias("category"), "doc_id", "page_number", F.col(item).alias("item"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def missing_translation(runs: DataFrame) -> DataFrame:
    """Text without translation, NULL or empty."""
    hit = runs.where((F.trim(F.coalesce("text", F.lit(""))) != "") & (F.coalesce("ru_text", F.lit("")) == ""))
    return _issue(hit, "translation.missing", "warning", "translation", "inline_id", "no translation")


def empty_translation(runs: DataFrame) -> DataFrame:
    """A translation that is there and blank; the empty string breaks this rule and the one above."""
    return _issue(runs.where(F.col("ru_text").isNotNull() & (F.trim("ru_text") == "")), "translation.empty", "error", "translation", "inline_id", "blank translation")


def low_confidence(pages: DataFrame) -> DataFrame:
    severity = F.when(F.col("route") == "hybrid", "warning").otherwise("info")
    return _issue(pages.where(F.col("route").isin("hybrid", "facsimile")).withColumn("item", F.col("route")), "confidence.low_page", severity, "confidence", "item", "page is not rendered semantically")


def caption_links(page_blocks: DataFrame) -> DataFrame:
    """Figures whose caption is unknown, captions whose parent is unknown or neither figure nor table."""
    ids = page_blocks.select("doc_id", "page_number", F.col("block_id").alias("other"), F.col("kind").alias("other_kind"))
    f = page_blocks.where((F.col("kind") == "figure") & F.col("caption_block_id").isNotNull()).withColumn("other", F.col("caption_block_id"))
    c = page_blocks.where((F.col("kind") == "caption") & F.col("parent_block_id").isNotNull()).withColumn("other", F.col("parent_block_id"))
    on = ["doc_id", "page_number", "other"]
    a = _issue(f.join(ids, on, "left_anti"), "entity.figure_caption_linkage", "error", "entity", "block_id", "caption does not exist")
    b = _issue(c.join(ids, on, "left_anti"), "entity.figure_caption_linkage", "error", "entity", "block_id", "parent does not exist")
    d = _issue(c.join(ids, on).where(~F.col("other_kind").isin("figure", "table")), "entity.figure_caption_linkage", "error", "entity", "block_id", "parent is neither figure nor table")
    return a.unionByName(b).unionByName(d)


def table_structure(tables: DataFrame) -> DataFrame:
    """Tables with dimensions and no cells, and cells outside of them: needs ``rows, cols, cells array<struct<row, col>>``."""
    none = tables.where((F.col("rows") > 0) & (F.col("cols") > 0) & (F.coalesce(F.size("cells"), F.lit(0)) <= 0))
    out = tables.select("doc_id", "page_number", "block_id", "rows", "cols", F.explode("cells").alias("c")).where((F.col("c.row") < 0) | (F.col("c.col") < 0) | (F.col("c.row") >= F.col("rows")) | (F.col("c.col") >= F.col("cols")))
    return _issue(none, "entity.table_structure", "error", "entity", "block_id", "dimensions without cells").unionByName(_issue(out, "entity.table_structure", "error", "entity", "block_id", "cell out of bounds"))


def callout_structure(page_blocks: DataFrame) -> DataFrame:
    hit = page_blocks.where((F.col("kind") == "callout") & (F.coalesce("content", F.lit("")) == ""))
    return _issue(hit, "entity.callout_structure", "warning", "entity", "block_id", "callout without content")


def region_graph(regions: DataFrame, edges: DataFrame) -> DataFrame:
    """Repeated regions, edges without one of their ends, edges onto themselves."""
    page = ["doc_id", "page_number"]
    twice = regions.groupBy(*page, "region_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    known = regions.select(*page, "region_id").distinct()
    out = _issue(twice, "extraction.region_graph", "error", "extraction", "region_id", "region id is not unique")
    for end in ("src", "dst"):
        lost = edges.withColumn("region_id", F.col(end)).join(known, [*page, "region_id"], "left_anti")
        out = out.unionByName(_issue(lost, "extraction.region_graph", "error", "extraction", "region_id", f"{end} of an edge does not exist"))
    return out.unionByName(_issue(edges.where("src = dst"), "extraction.region_graph", "error", "extraction", "src", "edge onto itself"))


def order_checks(regions: DataFrame, order: DataFrame) -> DataFrame:
    """Sequences with gaps, entries of unknown regions, regions left out (a warning)."""
    page = ["doc_id", "page_number"]
    gaps = order.groupBy(*page).agg(F.min("sequence_index").alias("a"), F.max("sequence_index").alias("b"), F.count_distinct("sequence_index").alias("d"), F.count(F.lit(1)).alias("n")).where("a <> 0 OR b <> n - 1 OR d <> n").withColumn("item", F.lit("order"))
    lost = order.join(regions.select(*page, "region_id"), [*page, "region_id"], "left_anti")
    left = layout.unassigned(regions, order)
    a = _issue(gaps, "extraction.reading_order", "error", "extraction", "item", "sequence is not contiguous")
    return a.unionByName(_issue(lost, "extraction.reading_order", "error", "extraction", "region_id", "unknown region")).unionByName(_issue(left, "extraction.reading_order", "warning", "extraction", "region_id", "region is not in the order"))


def symbol_anchors(symbols: DataFrame) -> DataFrame:
    return _issue(symbols.where(F.trim(F.coalesce("symbol_id", F.lit(""))) == ""), "symbol.anchor_validity", "error", "symbol", "primitive_id", "symbol without id")


class Rule(NamedTuple):
    """A rule and the tables that it takes, in order."""

    run: Callable[..., DataFrame]
    needs: tuple[str, ...]


#: Every rule by its name.
RULES: dict[str, Rule] = {
    "translation.missing": Rule(missing_translation, ("runs",)),
    "translation.empty": Rule(empty_translation, ("runs",)),
    "confidence.low_page": Rule(low_confidence, ("pages",)),
    "entity.figure_caption_linkage": Rule(caption_links, ("blocks",)),
    "entity.table_structure": Rule(table_structure, ("tables",)),
    "entity.callout_structure": Rule(callout_structure, ("blocks",)),
    "extraction.region_graph": Rule(region_graph, ("regions", "edges")),
    "extraction.reading_order": Rule(order_checks, ("regions", "reading_order")),
    "symbol.anchor_validity": Rule(symbol_anchors, ("symbols",)),
}


def evaluate(tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, rules: Mapping[str, Rule] | None = None) -> DataFrame:
    """Issues with ids of all ``rules`` (of those named in ``only``) whose tables are there.

    A rule that is named and lacks a table, or is not known, is an error.
    """
    known = RULES if rules is None else rules
    names = [*known] if only is None else [*only]
    if lost := [n for n in names if n not in known]:
        raise KeyError(f"unknown rules: {', '.join(lost)}")
    ready = [n for n in names if all(t in tables for t in known[n].needs)]
    if only is not None and len(ready) < len(names):
        raise KeyError(f"tables are missing for {', '.join(n for n in names if n not in ready)}")
    if not ready:
        raise ValueError("no rule has its tables")
    return with_ids(reduce(DataFrame.unionByName, [known[n].run(*(tables[t] for t in known[n].needs)) for n in ready]))


def with_ids(issues: DataFrame) -> DataFrame:
    return issues.withColumn("issue_id", issue_id(F.col("rule_id"), F.col("severity"), F.col("message"), F.col("page_number"), F.col("item")))


def by_category(issues: DataFrame) -> DataFrame:
    """Errors, warnings and infos of each category."""
    return issues.groupBy("category").agg(*[F.count_if(F.col("severity") == s).alias(n) for s, n in (("error", "errors"), ("warning", "warnings"), ("info", "infos"))])


def gate(issues: DataFrame, max_errors: int = 0, max_warnings: int = 50) -> DataFrame:
    """One row: counts and whether the run is accepted."""
    n = issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return n.withColumn("accepted", (F.col("errors") <= max_errors) & (F.col("warnings") <= max_warnings))


def gate_by_document(issues: DataFrame, documents: DataFrame, max_errors: int = 0, max_warnings: int = 50) -> DataFrame:
    """:func:`gate` of each document of ``documents``; one without issues is accepted."""
    n = issues.groupBy("doc_id").agg(*[F.count_if(F.col("severity") == s).alias(c) for s, c in (("error", "errors"), ("warning", "warnings"))])
    out = documents.select("doc_id").distinct().join(n, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("errors", "warnings")})
    return out.withColumn("accepted", (F.col("errors") <= max_errors) & (F.col("warnings") <= max_warnings))
