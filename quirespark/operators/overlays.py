"""Debug overlays as rows: a box, a colour and a label; drawing them on a page is left to a viewer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Colours by kind.
COLOURS = {"text": "blue", "image": "green", "table": "orange", "drawing": "purple", "band": "grey", "column": "blue", "sidebar": "teal", "figure": "green", "callout": "red", "header": "brown", "footer": "brown", "page_number": "black"}


def overlay(df: DataFrame, layer: str, kind: str, label, page: int | None = None) -> DataFrame:
    """``layer, doc_id, page_number, x0..y1, colour, label``; ``page`` keeps one page."""
    colour = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in COLOURS.items() for x in kv]), F.col(kind)), F.lit("black"))
    rows = df if page is None else df.where(F.col("page_number") == page)
    return rows.select(F.lit(layer).alias("layer"), "doc_id", "page_number", "x0", "y0", "x1", "y1", colour.alias("colour"), label.alias("label"))


def primitives(df: DataFrame, page: int | None = None) -> DataFrame:
    return overlay(df, "primitives", "kind", F.col("primitive_id"), page)


def furniture(found: DataFrame, page: int | None = None) -> DataFrame:
    return overlay(found.withColumn("page_number", F.explode("pages")), "furniture", "furniture_type", F.col("candidate_id"), page)


def regions(found: DataFrame, page: int | None = None) -> DataFrame:
    return overlay(found, "regions", "kind_hint", F.concat_ws(" ", "region_id", "kind_hint"), page)


def reading_order(found: DataFrame, order: DataFrame, page: int | None = None) -> DataFrame:
    both = found.join(order.select("doc_id", "page_number", "region_id", "sequence_index"), ["doc_id", "page_number", "region_id"])
    return overlay(both, "reading_order", "kind_hint", F.col("sequence_index").cast("string"), page)


def links(page_blocks: DataFrame, pairs: DataFrame, page: int | None = None) -> DataFrame:
    """Figures and captions that belong together share a label."""
    ends = pairs.select("doc_id", "page_number", F.explode(F.array("figure_id", "caption_id")).alias("block_id"), F.concat_ws(" - ", "figure_id", "caption_id").alias("pair"))
    return overlay(page_blocks.join(ends, ["doc_id", "page_number", "block_id"]), "links", "kind", F.col("pair"), page)


def confidence(pages: DataFrame, page: int | None = None) -> DataFrame:
    """One row a page over its whole box, coloured by route."""
    box = pages.select("doc_id", "page_number", "route", F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("x1"), F.lit(1.0).alias("y1"), "confidence")
    return overlay(box, "confidence", "route", F.format_string("%s %.2f", "route", "confidence"), page).withColumn("colour", F.when(F.startswith("label", F.lit("semantic")), "green").when(F.startswith("label", F.lit("hybrid")), "orange").otherwise("red"))
