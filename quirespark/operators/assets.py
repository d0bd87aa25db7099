"""Asset classes and their occurrences, and symbol candidates of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text as t
from ..functions.ids import asset_class_id, asset_occurrence_id, symbol_candidate_id
from .packs import standing

INLINE_AREA, FIGURE_AREA = 0.01, 0.04


def drawing_shape():
    """Drawings of the same number of paths and size are the same, wherever they stand."""
    return F.concat_ws(":", F.lit("vec"), F.col("path_count").cast("string"), F.bround(F.col("x1") - F.col("x0"), 2).cast("decimal(6,2)").cast("string"), F.bround(F.col("y1") - F.col("y0"), 2).cast("decimal(6,2)").cast("string"))


def occurrences(primitives: DataFrame, furniture: DataFrame | None = None) -> DataFrame:
    """Images and drawings with their class.

    ``doc_id, class_key, asset_id, occurrence_id, page_number, primitive_id,
    kind, is_furniture, context``.  Classes are numbered by key within kind and
    document, occurrences within class and page.
    """
    key = F.when(F.col("kind") == "image", F.col("content_hash")).otherwise(drawing_shape())
    pics = primitives.where(F.col("kind").isin("image", "drawing")).withColumn("class_key", key).where(F.col("class_key").isNotNull())
    if furniture is None:
        marked = pics.withColumn("is_furniture", F.lit(False))
    else:
        known = furniture.where((F.col("kind") == "image") & F.col("content_hash").isNotNull()).select(F.col("doc_id").alias("fd"), F.col("content_hash").alias("fk"), F.lit(True).alias("is_furniture")).distinct()
        marked = pics.join(known, (F.col("doc_id") == F.col("fd")) & (F.col("class_key") == F.col("fk")), "left").drop("fd", "fk").withColumn("is_furniture", F.coalesce("is_furniture", F.lit(False)))
    size = g.area(*g.box())
    image = F.col("kind") == "image"
    context = F.when(F.col("is_furniture"), "decoration").when(image & (size < INLINE_AREA), "inline").when(image & (size >= FIGURE_AREA), "figure").otherwise("unknown")
    # Distinct classes are numbered, not all pictures of a document.
    n = F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy("class_key")) - 1
    numbers = marked.select("doc_id", "kind", "class_key").distinct().withColumn("asset_id", asset_class_id(F.when(image, "raster").otherwise("vector"), n))
    named = marked.join(numbers.withColumnRenamed("doc_id", "__doc"), (F.col("doc_id").eqNullSafe(F.col("__doc"))) & (marked["kind"] == numbers["kind"]) & (marked["class_key"] == numbers["class_key"])).select(marked["*"], "asset_id")
    k = F.row_number().over(Window.partitionBy("doc_id", "asset_id", "page_number").orderBy("prim_ord", "primitive_id")) - 1
    return named.select("doc_id", "class_key", "asset_id", asset_occurrence_id(F.col("asset_id"), F.col("page_number"), k).alias("occurrence_id"), "page_number", "primitive_id", "kind", "is_furniture", context.alias("context"))


def classes(occurred: DataFrame) -> DataFrame:
    """``doc_id, asset_id, class_key, kind, occurrences, pages, is_furniture`` of each class."""
    return occurred.groupBy("doc_id", "asset_id", "class_key", "kind").agg(F.count(F.lit(1)).alias("occurrences"), F.array_sort(F.collect_set("page_number")).alias("pages"), F.max("is_furniture").alias("is_furniture"))


def token_matches(texts: DataFrame, tokens: DataFrame) -> DataFrame:
    """Texts that hold a symbol's token (as written), with where it stands.

    ``tokens(symbol_id, token)`` is a pack: a dimension of fixed size; a token at
    the start and before a blank is a line prefix.
    """
    rest = F.substring(F.ltrim("text"), F.length("token") + 1, 1)
    prefix = F.startswith(F.ltrim("text"), F.col("token")) & ((rest == "") | F.rlike(rest, F.lit(r"^\s")))
    anchor = F.when(prefix, "line_prefix").otherwise("inline")
    found = standing(texts.select("doc_id", "page_number", "primitive_id", "prim_ord", "text"), "text", tokens, "token").join(tokens.select("symbol_id", "token"), "token")
    return found.select("doc_id", "page_number", "primitive_id", "prim_ord", F.lit("text_token").alias("evidence_source"), "symbol_id", F.col("token").alias("raw"), anchor.alias("anchor_type"), F.lit(True).alias("is_classified"))


def hash_matches(pictures: DataFrame, hashes: DataFrame, source: str = "raster_hash") -> DataFrame:
    """Pictures of a class that a symbol names by content hash or shape: ``hashes(symbol_id, class_key)``."""
    small = (F.col("x1") - F.col("x0") < 0.05) & (F.col("y1") - F.col("y0") < 0.05)
    key = F.when(F.col("kind") == "image", F.col("content_hash")).otherwise(drawing_shape())
    usable = pictures.where((F.col("kind") == "image") | ~F.coalesce("is_decorative", F.lit(False))).withColumn("class_key", key)
    return usable.join(hashes, "class_key").select("doc_id", "page_number", "primitive_id", "prim_ord", F.lit(source).alias("evidence_source"), "symbol_id", F.col("class_key").alias("raw"), F.when(small, "inline").otherwise("block_attached").alias("anchor_type"), F.lit(True).alias("is_classified"))


def dingbats(texts: DataFrame) -> DataFrame:
    """Distinct pictographic characters of each text, none classified; the first of each counts."""
    found = texts.where(t.has_dingbat(F.col("text"))).select("doc_id", "page_number", "primitive_id", "prim_ord", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({t.DINGBATS})"), F.lit(1)))).alias("raw"))
    return found.select("doc_id", "page_number", "primitive_id", "prim_ord", F.lit("dingbat").alias("evidence_source"), F.lit(None).cast("string").alias("symbol_id"), "raw", F.lit("inline").alias("anchor_type"), F.lit(False).alias("is_classified"))


def symbol_candidates(*parts: DataFrame) -> DataFrame:
    """Findings of all detectors of a page in one numbered table, in the order of ``parts``."""
    every = None
    for rank, part in enumerate(parts):
        own = part.withColumn("__rank", F.lit(rank))
        every = own if every is None else every.unionByName(own)
    n = F.row_number().over(Window.partitionBy("doc_id", "page_number").orderBy("__rank", "prim_ord", "primitive_id", "symbol_id", "raw")) - 1
    return every.withColumn("candidate_id", symbol_candidate_id(F.col("page_number"), n)).drop("__rank", "prim_ord")


def symbol_summary(candidates: DataFrame) -> DataFrame:
    """Counts of each document's candidates and its sorted symbols."""
    return candidates.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_classified").alias("classified"), F.count_if(~F.col("is_classified")).alias("unclassified"),
        F.array_sort(F.collect_set("symbol_id")).alias("symbol_ids"),
    )


def best_candidates(candidates: DataFrame) -> DataFrame:
    """The candidate of highest confidence of each primitive, of equals the first; needs ``confidence``."""
    w = Window.partitionBy("doc_id", "page_number", "primitive_id").orderBy(F.desc("confidence"), "candidate_id")
    return candidates.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def tag_figures(page_blocks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Figures whose asset or id is the primitive of a candidate get its symbol as ``alt_text``; the asset goes first."""
    best = best_candidates(candidates).select("doc_id", "page_number", F.col("primitive_id").alias("__p"), F.col("symbol_id").alias("__s"))
    page = ["doc_id", "page_number"]
    a = best.withColumnsRenamed({"__p": "asset_ref", "__s": "__a"})
    b = best.withColumnsRenamed({"__p": "block_id", "__s": "__b"})
    out = page_blocks.join(a, [*page, "asset_ref"], "left").join(b, [*page, "block_id"], "left")
    return out.withColumn("alt_text", F.when(F.col("kind") == "figure", F.coalesce("__a", "__b"))).drop("__a", "__b")


def by_page(pages: DataFrame, **tables: DataFrame) -> DataFrame:
    """Pages with an array of rows of each table, empty where a page has none; tables need ``doc_id, page_number``."""
    page = ["doc_id", "page_number"]
    for name, table in tables.items():
        own = table.groupBy(*page).agg(F.array_sort(F.collect_list(F.struct(*[c for c in table.columns if c not in page]))).alias(name))
        kind = own.schema[name].dataType
        pages = pages.join(own, page, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return pages
