"""Figures and their captions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text as t

FURTHEST, LEAST_SCORE = 0.30, 0.10
PAGE = ("doc_id", "page_number")


def score_pairs(figures: DataFrame, captions: DataFrame) -> DataFrame:
    """Figure and caption of one page with a score of at least ``LEAST_SCORE``.

    Both need ``doc_id, page_number, block_id, ord, x0..y1``.  The score weighs
    horizontal overlap and nearness; a caption below its figure is preferred.
    """
    f = figures.select(*PAGE, F.col("block_id").alias("figure_id"), F.col("ord").alias("figure_ord"), *[F.col(c).alias("f_" + c) for c in ("x0", "y0", "x1", "y1")])
    c = captions.select(*PAGE, F.col("block_id").alias("caption_id"), F.col("ord").alias("caption_ord"), *[F.col(k).alias("c_" + k) for k in ("x0", "y0", "x1", "y1")])
    both = f.join(c, list(PAGE))
    dist = g.y_distance(g.box("f_"), g.box("c_"))
    near = F.greatest(F.lit(0.0), F.when(dist >= 0, 1.0).otherwise(0.8) - F.abs(dist) * 3)
    score = F.least(F.lit(1.0), 0.6 * g.x_overlap(g.box("f_"), g.box("c_")) + 0.4 * near)
    return both.where(F.abs(dist) <= FURTHEST).withColumn("score", score).where(F.col("score") >= LEAST_SCORE).select(*PAGE, "figure_id", "caption_id", "figure_ord", "caption_ord", "score")


def greedy_links(scored: DataFrame) -> DataFrame:
    """Best pairs first, each figure and caption once; ties go by order.  State depends on what was taken, so pages run in pandas."""

    def run(page: pd.DataFrame) -> pd.DataFrame:
        figures, captions, keep = set(), set(), []
        for row in page.sort_values(["score", "figure_ord", "caption_ord", "figure_id", "caption_id"], ascending=[False, True, True, True, True]).itertuples():
            if row.figure_id not in figures and row.caption_id not in captions:
                figures.add(row.figure_id)
                captions.add(row.caption_id)
                keep.append(row.Index)
        return page.loc[keep, ["doc_id", "page_number", "figure_id", "caption_id", "score"]]

    return scored.groupBy(*PAGE).applyInPandas(run, "doc_id string, page_number int, figure_id string, caption_id string, score double")


def sequential_links(figures: DataFrame, captions: DataFrame) -> DataFrame:
    """The n-th figure of a page goes with its n-th caption; the score falls with their distance in the order of blocks."""
    w = Window.partitionBy(*PAGE).orderBy("ord", "block_id")
    f = figures.select(*PAGE, F.col("block_id").alias("figure_id"), F.col("ord").alias("figure_ord"), F.row_number().over(w).alias("n"))
    c = captions.select(*PAGE, F.col("block_id").alias("caption_id"), F.col("ord").alias("caption_ord"), F.row_number().over(w).alias("n"))
    return f.join(c, [*PAGE, "n"]).select(*PAGE, "figure_id", "caption_id", F.greatest(F.lit(0.3), 1 - 0.1 * F.abs(F.col("figure_ord") - F.col("caption_ord"))).alias("score"))


def apply_links(page_blocks: DataFrame, links: DataFrame) -> DataFrame:
    """Adds ``caption_block_id`` to figures and ``parent_block_id`` to captions."""
    a = links.select(F.col("figure_id").alias("block_id"), F.col("caption_id").alias("caption_block_id"))
    b = links.select(F.col("caption_id").alias("block_id"), F.col("figure_id").alias("parent_block_id"))
    return page_blocks.join(a, "block_id", "left").join(b, "block_id", "left")



def resolve_figures(regions: DataFrame, page_blocks: DataFrame) -> DataFrame:
    """The n-th figure region of a page (from the top, then from the left) is its n-th figure block; surplus on either side is left out."""
    r = regions.where("kind_hint = 'figure'").select(*PAGE, "region_id", F.row_number().over(Window.partitionBy(*PAGE).orderBy("y0", "x0", "region_id")).alias("n"))
    b = page_blocks.where("kind = 'figure'").select(*PAGE, "block_id", F.row_number().over(Window.partitionBy(*PAGE).orderBy("block_ord", "block_id")).alias("n"))
    return r.join(b, [*PAGE, "n"]).select(*PAGE, "region_id", "block_id")


def resolve_captions(texts: DataFrame, page_blocks: DataFrame) -> DataFrame:
    """Primitives and the caption block of their page with the same text; of equal blocks the last."""
    b = page_blocks.where("kind = 'caption'").groupBy(*PAGE, F.trim("content").alias("__text")).agg(F.max_by("block_id", F.struct("block_ord", "block_id")).alias("block_id"))
    return texts.withColumn("__text", F.trim("text")).join(b, [*PAGE, "__text"]).select(*PAGE, "primitive_id", "block_id")


def figure_captions(found: DataFrame, texts: DataFrame, page_blocks: DataFrame) -> DataFrame:
    """``doc_id, page_number, figure_id, caption_id, score`` of the blocks of figure regions and of the captions that go with them."""
    box = ["x0", "y0", "x1", "y1"]
    f = found.where(F.col("kind_hint") == "figure").select(*PAGE, F.col("region_id").alias("block_id"), F.element_at(F.split("region_id", ":"), -1).cast("int").alias("ord"), *box)
    c = texts.where(t.is_caption(F.trim("text"))).select(*PAGE, F.col("primitive_id").alias("block_id"), F.col("prim_ord").alias("ord"), *box)
    best = greedy_links(score_pairs(f, c))
    figures = resolve_figures(found, page_blocks).select(*PAGE, F.col("region_id").alias("figure_id"), F.col("block_id").alias("__f"))
    captions = resolve_captions(texts, page_blocks).select(*PAGE, F.col("primitive_id").alias("caption_id"), F.col("block_id").alias("__c"))
    return best.join(figures, [*PAGE, "figure_id"]).join(captions, [*PAGE, "caption_id"]).select(*PAGE, F.col("__f").alias("figure_id"), F.col("__c").alias("caption_id"), "score")
