"""Public bundle: projections, catalog, routes and what a reader asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick(en: Column, ru: Column, locale: str) -> Column:
    """Text in a locale; an empty translation falls back to the source."""
    return en if locale == "en" else F.coalesce(F.nullif(ru, F.lit("")), en)


def public_blocks(page_blocks: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Blocks without internal columns but those named in ``also``; references to assets become paths under the document."""
    keep = [c for c in ("doc_id", "page_number", "block_ord", "block_id", "kind", "level", "content", "asset_ref", *also) if c in page_blocks.columns]
    out = page_blocks.select(*keep)
    return out.withColumn("asset_ref", F.when(F.length("asset_ref") > 0, F.concat(F.lit("/assets/"), F.col("doc_id"), F.lit("/"), F.col("asset_ref")))) if "asset_ref" in keep else out


def with_symbols(refs: DataFrame, symbols: DataFrame) -> DataFrame:
    """Label, drawing and alternative text of symbols; the reference's own text first, then label, then id."""
    s = symbols.select("symbol_id", "label", "svg_path", F.col("alt_text").alias("default_alt"))
    return refs.join(s, "symbol_id", "left").withColumn("alt", F.coalesce(F.nullif("alt_text", F.lit("")), F.nullif("default_alt", F.lit("")), F.nullif("label", F.lit("")), "symbol_id"))


def upsert_catalog(catalog: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``new`` replace those of the same document; ``include_in_catalog`` false removes them."""
    kept = catalog.join(new.select(key), key, "left_anti")
    added = new.where(F.coalesce("include_in_catalog", F.lit(True))) if "include_in_catalog" in new.columns else new
    return kept.unionByName(added.select(*catalog.columns))


def routes(documents: DataFrame) -> DataFrame:
    """Every page of every document with the pages before and after it: ``doc_id, page_number, route, prev_page, next_page``."""
    pages = documents.where(F.col("page_count") > 0).select("doc_id", "page_count", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page_number"))
    return pages.select(
        "doc_id", "page_number", F.concat(F.lit("/docs/"), F.col("doc_id"), F.lit("/page/"), F.col("page_number").cast("string")).alias("route"),
        F.when(F.col("page_number") > 1, F.col("page_number") - 1).alias("prev_page"), F.when(F.col("page_number") < F.col("page_count"), F.col("page_number") + 1).alias("next_page"),
    )


def spaced_text(inlines: DataFrame, keys: list[str], order: list[str], text: str = "text") -> DataFrame:
    """Inline texts of a block as one: a blank between neighbours unless either is empty or has one at the border."""
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = F.lag(F.coalesce(text, F.lit(""))).over(w)
    own = F.coalesce(text, F.lit(""))
    space = F.when(prev.isNull() | (prev == "") | (own == "") | F.rlike(prev, F.lit(r"\s$")) | F.rlike(own, F.lit(r"^\s")), "").otherwise(" ")
    parts = inlines.select(*keys, F.row_number().over(w).alias("__n"), F.concat(space, own).alias("__t"))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", "__t"))), lambda x: x["__t"]), "").alias("text"))


def table_grid(cells: DataFrame, keys: list[str], columns: int) -> DataFrame:
    """Cells as a dense grid, one row a table row; of repeated cells the last one counts."""
    pivoted = cells.groupBy(*keys, "row").pivot("col", list(range(columns))).agg(F.max_by("text", "cell_ord"))
    return pivoted.select(*keys, "row", *[F.coalesce(F.col(str(k)), F.lit("")).alias(f"c{k}") for k in range(columns)])


def render_mode(route: Column, kind: Column) -> Column:
    """What a reader shows of a block: nothing on pages that are shown as an image."""
    return F.when(route == "facsimile", "image").when(kind == "heading", "heading").when(kind == "list", "list").when(kind == "figure", "figure").when(kind == "table", "table").when(kind == "callout", "callout").otherwise("text")


def html(page_blocks: DataFrame) -> DataFrame:
    """Adds ``html``: a block as markup by its kind, text escaped."""
    safe = F.coalesce("content", F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(a), F.lit(b))
    level = F.least(F.coalesce("level", F.lit(2)), F.lit(6)).cast("string")
    items = F.array_join(F.transform(F.split(safe, "\n"), lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), "")
    wrap = lambda tag, x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))
    out = F.when(F.col("kind") == "heading", F.concat(F.lit("<h"), level, F.lit(">"), safe, F.lit("</h"), level, F.lit(">"))).when(F.col("kind") == "list", wrap("ul", items)).when(F.col("kind") == "caption", wrap("figcaption", safe)).when(F.col("kind") == "callout", wrap("aside", safe)).otherwise(wrap("p", safe))
    return page_blocks.withColumn("html", out)


def contents(entries: DataFrame, depth: int = 2) -> DataFrame:
    """Rows of a table of contents in order: ``doc_id, path, depth, anchor_id`` of entries with ``parent``.

    A self-join a level; parents are of level 1, so that two levels are all.
    """
    top = entries.where(F.col("parent").isNull()).select("doc_id", "anchor_id", "page_number", F.array("anchor_id").alias("path"), F.lit(1).alias("depth"))
    every, level = top, top
    for n in range(2, depth + 1):
        up = level.select(F.col("doc_id").alias("__d"), F.col("anchor_id").alias("__p"), F.col("path").alias("__path"))
        level = entries.join(up, (F.col("doc_id") == F.col("__d")) & (F.col("parent") == F.col("__p"))).select("doc_id", "anchor_id", "page_number", F.concat("__path", F.array("anchor_id")).alias("path"), F.lit(n).alias("depth"))
        every = every.unionByName(level)
    return every
