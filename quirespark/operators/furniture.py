"""Furniture: what returns at the same place of many pages of a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text as t
from ..functions.ids import fingerprint

MIN_RATE, EDGE, STEP = 0.5, 0.08, 0.02


def cluster_key(step: float = STEP):
    """Primitives with the same key are the same thing on different pages.

    Position on a grid and, by kind, font and text (numbers of pages without
    their text), content of an image, or shape of a drawing.
    """
    place = F.concat_ws(",", *[g.grid(F.col(c), step).cast("string") for c in ("x0", "y0", "x1", "y1")])
    font = F.concat_ws("@", F.coalesce("font_name", F.lit("")), F.rint(F.coalesce("font_size", F.lit(0.0)) * 10).cast("int").cast("string"))
    words = F.when(t.is_page_number(F.trim(F.col("text"))), F.lit("#")).otherwise(fingerprint(F.trim(F.coalesce("text", F.lit(""))), 12))
    return F.concat_ws(
        "|", "kind", place,
        F.when(F.col("kind") == "text", F.concat_ws("|", font, words))
        .when(F.col("kind") == "image", F.substring(F.coalesce("content_hash", F.lit("")), 1, 16))
        .otherwise(F.concat_ws("|", F.coalesce(F.col("path_count").cast("string"), F.lit("")), F.coalesce(F.col("is_decorative").cast("string"), F.lit("")))),
    )


def furniture_type(edge: float = EDGE):
    """Kind of furniture by place and content; the first that applies."""
    text, drawing = F.col("kind") == "text", F.col("kind") == "drawing"
    top, bottom = F.col("y0") < edge, F.col("y1") > 1.0 - edge
    size = g.area(*g.box())
    decorative = F.coalesce("is_decorative", F.lit(False))
    return (
        F.when(text & bottom & t.is_page_number(F.col("text_sample")), "page_number")
        .when(text & top, "header")
        .when(text & bottom, "footer")
        .when(drawing & decorative, F.when(size > 0.3, "border").otherwise("ornament"))
        .when(drawing & (F.col("x1") - F.col("x0") > 0.5) & (F.col("y1") - F.col("y0") < 0.02), "divider")
        .when(drawing, "border")
        .when(size > 0.3, "background_panel")
        .otherwise("ornament")
    )


def candidates(primitives: DataFrame, min_rate: float = MIN_RATE, edge: float = EDGE, step: float = STEP) -> DataFrame:
    """Furniture of each document, numbered by first appearance.

    ``doc_id, candidate_id, furniture_type, kind, x0..y1`` (medians), ``pages``
    (sorted), ``repetition_rate, confidence, text_sample, content_hash``.
    Documents of one page have none.  Pages are those with any primitive.
    The exact medians are taken after the clusters are known to be large enough,
    so that single lines cost one partial count each.
    """
    keyed = primitives.where(F.col("kind").isin("text", "image", "drawing")).withColumn("key", cluster_key(step))
    pages = primitives.groupBy("doc_id").agg(F.count_distinct("page_number").alias("total_pages"))
    rank = F.when(F.col("kind") == "text", 0).when(F.col("kind") == "image", 1).otherwise(2)
    # The position of first appearance orders clusters as a single pass over the pages would.
    first = F.struct("page_number", rank.alias("rank"), "prim_ord", "primitive_id")
    counts = keyed.groupBy("doc_id", "key").agg(F.count_distinct("page_number").alias("page_count"), F.min(first).alias("first"))
    frequent = counts.join(pages, "doc_id").where((F.col("total_pages") >= 2) & (F.col("page_count") >= min_rate * F.col("total_pages")))
    members = keyed.join(frequent, ["doc_id", "key"])
    grouped = members.groupBy("doc_id", "key", "first", "page_count", "total_pages").agg(
        *[F.median(c).alias(c) for c in ("x0", "y0", "x1", "y1")],
        F.array_sort(F.collect_set("page_number")).alias("pages"),
        *[F.min_by(c, first).alias(n) for c, n in (("kind", "kind"), (F.substring("text", 1, 80), "text_sample"), ("content_hash", "content_hash"), ("is_decorative", "is_decorative"))],
    )
    near = (F.col("y0") < edge) | (F.col("y1") > 1.0 - edge) | (F.col("x0") < edge) | (F.col("x1") > 1.0 - edge)
    number = (F.col("kind") == "text") & F.coalesce(t.is_page_number(F.col("text_sample")), F.lit(False))
    kept = grouped.where(near | F.coalesce("is_decorative", F.lit(False)) | number)
    typed = kept.withColumn("furniture_type", furniture_type(edge)).withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("first")) - 1)
    rate = F.col("page_count") / F.col("total_pages")
    return typed.select(
        "doc_id", F.format_string("furn:%s:%03d", "furniture_type", "n").alias("candidate_id"), "furniture_type", "kind", "x0", "y0", "x1", "y1", "pages",
        rate.alias("repetition_rate"), F.least(F.lit(1.0), rate / min_rate).alias("confidence"), "text_sample", "content_hash",
    )


def page_furniture(found: DataFrame) -> DataFrame:
    """``doc_id, page_number, furniture_ids, furniture_fraction``: what is on a page and how much of it is covered."""
    size = g.area(*g.box())
    return (
        found.select("doc_id", "candidate_id", size.alias("size"), F.explode("pages").alias("page_number"))
        .groupBy("doc_id", "page_number")
        .agg(F.array_sort(F.collect_set("candidate_id")).alias("furniture_ids"), F.least(F.lit(1.0), F.sum("size")).alias("furniture_fraction"))
    )


def templates(found: DataFrame) -> DataFrame:
    """Pages with the same set of furniture: ``doc_id, template_id, furniture_ids, pages``."""
    sets = page_furniture(found)
    grouped = sets.groupBy("doc_id", "furniture_ids").agg(F.array_sort(F.collect_list("page_number")).alias("pages"))
    return grouped.select("doc_id", F.concat(F.lit("tpl:"), fingerprint(F.array_join("furniture_ids", ":"), 8)).alias("template_id"), "furniture_ids", "pages")


def mask(primitives: DataFrame, found: DataFrame) -> DataFrame:
    """Primitives that no furniture of their page covers by more than half; decorative drawings are left out too."""
    area = found.select(F.col("doc_id").alias("fd"), F.explode("pages").alias("fp"), *[F.col(c).alias("f" + c) for c in ("x0", "y0", "x1", "y1")])
    both = g.overlap_area(g.box(), g.box("f"))
    own = g.area(*g.box())
    hit = (F.col("doc_id") == F.col("fd")) & (F.col("page_number") == F.col("fp")) & F.when(own > 0, both > 0.5 * own).otherwise(g.contains(g.box("f"), g.box()))
    return primitives.where(~((F.col("kind") == "drawing") & F.coalesce("is_decorative", F.lit(False)))).join(area, hit, "left_anti")
