"""Bands, columns, regions and reading order of pages: windows of page size, one shuffle by page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g

GAP, GUTTER, SIDEBAR, CALLOUT_AREA = 0.03, 0.02, 0.35, 0.005
PAGE = ("doc_id", "page_number")


def bands(primitives: DataFrame, gap: float = GAP) -> DataFrame:
    """Adds ``band_index``: a band ends where nothing reaches within ``gap`` of the next primitive."""
    w = Window.partitionBy(*PAGE).orderBy("y0", "prim_ord", "primitive_id")
    reach = F.max("y1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = primitives.withColumn("__new", F.when(F.col("y0") - reach >= gap, 1).otherwise(0))
    return flagged.withColumn("band_index", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def merged_spans(banded: DataFrame) -> DataFrame:
    """``doc_id, page_number, band_index, span, s0, s1``: occupied horizontal intervals of each band, merged where they touch."""
    w = Window.partitionBy(*PAGE, "band_index").orderBy("x0", "x1", "primitive_id")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = banded.withColumn("__new", F.when(F.col("x0") <= reach, 0).otherwise(1))
    numbered = flagged.withColumn("span", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int") - 1)
    return numbered.groupBy(*PAGE, "band_index", "span").agg(F.min("x0").alias("s0"), F.max("x1").alias("s1"))


def gutters(banded: DataFrame, gutter: float = GUTTER) -> DataFrame:
    """``doc_id, page_number, band_index, gutter_x``: middle of the widest gap of each band that is wide enough; the leftmost of equals."""
    w = Window.partitionBy(*PAGE, "band_index").orderBy("span")
    gaps = merged_spans(banded).withColumn("next", F.lead("s0").over(w)).where(F.col("next").isNotNull()).withColumn("gap", F.col("next") - F.col("s1"))
    best = gaps.groupBy(*PAGE, "band_index").agg(F.max_by(F.struct("gap", ((F.col("s1") + F.col("next")) / 2).alias("x")), F.struct("gap", -F.col("span"))).alias("best"))
    return best.where(F.col("best.gap") >= gutter).select(*PAGE, "band_index", F.col("best.x").alias("gutter_x"))


def columns(banded: DataFrame, gutter: float = GUTTER) -> DataFrame:
    """Adds ``column_index`` (0 or 1; NULL where the band has one column), by the gutter of :func:`gutters`.

    Windows over the bands of a page: what is partitioned by page is not shuffled again.
    """
    band = Window.partitionBy(*PAGE, "band_index")
    reach = F.max("x1").over(band.orderBy("x0", "x1", "primitive_id").rowsBetween(Window.unboundedPreceding, -1))
    x0 = F.col("x0")
    gaps = banded.withColumn("__reach", reach).withColumn("__gap", F.when(x0 > F.col("__reach"), F.struct((x0 - F.col("__reach")).alias("gap"), (-x0).alias("left"), ((F.col("__reach") + x0) / 2).alias("x"))))
    best = gaps.withColumn("__best", F.max("__gap").over(band))
    side = F.when((x0 + F.col("x1")) / 2 < F.col("__best.x"), 0).otherwise(1)
    return best.withColumn("column_index", F.when(F.col("__best.gap") >= gutter, side)).drop("__reach", "__gap", "__best")


def _boxes() -> list:
    return [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.array_sort(F.collect_list("primitive_id")).alias("sources")]


def table_confidence():
    """Confidence in a table by the way it was found, its size and the text lying in it."""
    base = F.when(F.col("extraction_strategy") == "lines_strict", 0.9).when(F.col("extraction_strategy") == "lines", 0.8).otherwise(0.7)
    change = (
        F.when((F.col("rows") <= 1) & (F.col("cols") <= 1), -0.25).otherwise(0.0)
        + F.when(F.col("cell_count") <= 2, -0.15).otherwise(0.0)
        + F.when((F.col("rows") >= 2) & (F.col("cols") >= 2) & (F.col("cell_count") >= 4), 0.05).otherwise(0.0)
        + F.when(F.col("text_overlap") > 0.5, -0.2).otherwise(0.0)
    )
    return F.bround(g.clamp(base + change), 2)


def enclosures(primitives: DataFrame, least: float = CALLOUT_AREA) -> DataFrame:
    """Drawings that hold texts: ``doc_id, page_number, primitive_id, texts, density`` of those with an area of ``least``."""
    d = primitives.where((F.col("kind") == "drawing") & ~F.coalesce("is_decorative", F.lit(False)) & (g.area(*g.box()) >= least))
    d = d.select(*[F.col(c).alias("d_" + c) for c in (*PAGE, "primitive_id", "x0", "y0", "x1", "y1")])
    x = primitives.where(F.col("kind") == "text")
    inside = (F.col("doc_id") == F.col("d_doc_id")) & (F.col("page_number") == F.col("d_page_number")) & g.contains(g.box("d_"), g.box())
    return (
        d.join(x, inside)
        .groupBy(F.col("d_doc_id").alias("doc_id"), F.col("d_page_number").alias("page_number"), F.col("d_primitive_id").alias("primitive_id"))
        .agg(F.count(F.lit(1)).alias("texts"), (F.sum(g.area(*g.box())) / F.first(g.area(*g.box("d_")))).alias("density"), F.array_sort(F.collect_list(F.col("primitive_id"))).alias("text_ids"))
    )


def regions(primitives: DataFrame, gap: float = GAP, gutter: float = GUTTER) -> DataFrame:
    """Region graph vertices of each page, numbered band by band.

    ``doc_id, page_number, region_id, kind_hint, band_index, column_index,
    parent_region_id, x0..y1, sources, column_count, confidence``.  Within a band
    come its columns (a narrow one is a sidebar), figures, tables and callouts;
    a table of one cell that is mostly text is a callout.
    """
    banded = columns(bands(primitives, gap), gutter)
    kind, none = F.col("kind"), F.lit(None)
    slot = lambda rank, ord_, own=none.cast("string"): F.struct(F.lit(rank).alias("rank"), ord_.alias("ord"), own.alias("own"))
    pid, number = F.col("primitive_id"), F.col("prim_ord")
    # A primitive is part of its band, of its column and, unless it is a text, a region of its own.
    slots = F.array_compact(F.array(
        slot(0, F.lit(0)), F.when(F.col("column_index").isNotNull(), slot(1, F.col("column_index"))),
        F.when(kind == "image", slot(2, number, pid)).when(kind == "table", slot(3, number, pid)).when(kind == "drawing", slot(4, number, pid)),
    ))
    parts = banded.select("*", F.explode(slots).alias("__slot")).select("*", "__slot.*")
    two = F.coalesce(F.max("column_index") - F.min("column_index"), F.lit(0)) + 1
    only = [F.max(c).alias(c) for c in ("rows", "cols", "cell_count", "extraction_strategy")]
    every = parts.groupBy(*PAGE, "band_index", "rank", "ord", "own").agg(*_boxes(), two.cast("int").alias("column_count"), *only)
    on = [*PAGE, "own"]
    texts = banded.where(kind == "text").select(*[F.col(c).alias("t_" + c) for c in (*PAGE, "band_index", "x0", "y0", "x1", "y1")])
    same = [F.col(c) == F.col("t_" + c) for c in (*PAGE, "band_index")]
    overlap = banded.where(kind == "table").join(texts, same).groupBy(*PAGE, pid.alias("own")).agg(F.avg(F.when(g.contains(g.box(), g.box("t_")), 1.0).otherwise(0.0)).alias("text_overlap"))
    held = enclosures(primitives).withColumnRenamed("primitive_id", "own").drop("text_ids")
    full = every.join(overlap, on, "left").join(held, on, "left").where((F.col("rank") < 4) | F.col("texts").isNotNull()).withColumn("text_overlap", F.coalesce("text_overlap", F.lit(0.0)))
    width = F.max(F.when(F.col("rank") == 0, F.col("x1") - F.col("x0"))).over(Window.partitionBy(*PAGE, "band_index"))
    marked = full.withColumns({"__width": width, "__table": table_confidence()})
    rank = F.col("rank")
    side = (F.col("__width") > 0) & ((F.col("x1") - F.col("x0")) / F.col("__width") < SIDEBAR)
    box = (F.col("rows") <= 1) & (F.col("cols") <= 1) & (F.col("text_overlap") > 0) & (F.col("__table") < 0.5)
    sure = F.lit(0.6) + F.when(F.col("texts") >= 3, 0.1).otherwise(0.0) + F.when(F.col("density") > 0.1, 0.05).otherwise(0.0)
    hint = F.when(rank == 0, "band").when((rank == 1) & side, "sidebar").when(rank == 1, "column").when(rank == 2, "figure").when((rank == 3) & ~F.coalesce(box, F.lit(False)), "table").otherwise("callout")
    confidence = F.when(rank == 0, 0.9).when((rank == 1) & side, 0.7).when(rank == 1, 0.85).when(rank == 2, 0.8).when((rank == 3) & F.coalesce(box, F.lit(False)), 0.55).when(rank == 3, F.col("__table")).otherwise(sure)
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("band_index", "rank", "ord", "x0", "y0")) - 1
    named = marked.withColumn("region_id", F.format_string("reg:%d:%d", "page_number", n))
    parent = F.first(F.when(rank == 0, F.col("region_id")), ignorenulls=True).over(Window.partitionBy(*PAGE, "band_index"))
    return named.select(
        *PAGE, "band_index", "x0", "y0", "x1", "y1", "sources", hint.alias("kind_hint"), F.when(rank == 1, F.col("ord")).alias("column_index"),
        F.when(rank == 0, F.col("column_count")).alias("column_count"), confidence.alias("confidence"), "region_id", F.when(rank > 0, parent).alias("parent_region_id"),
    )


def edges(found: DataFrame) -> DataFrame:
    """``contains`` from a band to its parts and ``adjacent_to`` from a band to the next."""
    part = found.where(F.col("parent_region_id").isNotNull()).select(*PAGE, F.lit("contains").alias("edge_type"), F.col("parent_region_id").alias("src"), F.col("region_id").alias("dst"))
    w = Window.partitionBy(*PAGE).orderBy("band_index")
    nxt = found.where(F.col("kind_hint") == "band").select(*PAGE, F.lit("adjacent_to").alias("edge_type"), F.col("region_id").alias("src"), F.lead("region_id").over(w).alias("dst"))
    return part.unionByName(nxt.where(F.col("dst").isNotNull()))


def reading_order(found: DataFrame) -> DataFrame:
    """Order of the regions of each page.

    Bands from the top; of a band its columns, or itself where it has none, then
    figures and tables by height, then sidebars and callouts by height.  A band of
    one column between bands of more is an interruption.
    """
    kind = F.col("kind_hint")
    w = Window.partitionBy(*PAGE, "band_index")
    has = F.max(F.when(kind == "column", 1).otherwise(0)).over(w) == 1
    count = F.max("column_count").over(w)
    page = Window.partitionBy(*PAGE).orderBy("band_index")
    before = F.max(F.col("columns") > 1).over(page.rangeBetween(Window.unboundedPreceding, -1))
    after = F.max(F.col("columns") > 1).over(page.rangeBetween(1, Window.unboundedFollowing))
    phase = F.when(kind.isin("band", "column"), 0).when(kind.isin("figure", "table"), 1).otherwise(2)
    marked = found.withColumns({"__has": has, "columns": count}).where(~((kind == "band") & F.col("__has")))
    marked = marked.withColumn("flow_role", F.when(F.col("kind_hint").isin("sidebar", "callout"), "aside").when((F.col("kind_hint") == "band") & (F.col("columns") == 1) & F.coalesce(before, F.lit(False)) & F.coalesce(after, F.lit(False)), "interruption").otherwise("main"))
    key = F.when(phase == 0, F.coalesce("column_index", F.lit(0)).cast("double")).otherwise(F.col("y0"))
    seq = F.row_number().over(Window.partitionBy(*PAGE).orderBy("band_index", phase, key, "region_id")) - 1
    return marked.select(*PAGE, seq.alias("sequence_index"), "region_id", "kind_hint", "flow_role", "band_index", "column_index", "confidence")


def unassigned(found: DataFrame, order: DataFrame) -> DataFrame:
    """Regions that the reading order leaves out; a band stands for its columns where it has any."""
    columns = found.where("kind_hint = 'column'").select(*PAGE, "band_index", F.lit("band").alias("kind_hint")).distinct()
    left = found.join(order, [*PAGE, "region_id"], "left_anti")
    return left.join(columns, [*PAGE, "band_index", "kind_hint"], "left_anti").select(*PAGE, "region_id")


def canonical_flags(found: DataFrame) -> DataFrame:
    """``has_tables, has_figures, has_callouts, estimated_columns`` of each page."""
    flag = lambda kind, name: F.bool_or(F.col("kind_hint") == kind).alias(name)
    return found.groupBy(*PAGE).agg(flag("table", "has_tables"), flag("figure", "has_figures"), flag("callout", "has_callouts"), F.coalesce(F.max("column_count"), F.lit(1)).alias("estimated_columns"))


def page_confidence(found: DataFrame, order: DataFrame, page_furniture: DataFrame) -> DataFrame:
    """``confidence, route`` of each page: 1 less what speaks against a faithful structure.

    ``semantic`` from 0.6, ``hybrid`` from 0.3, else ``facsimile``.
    """
    r = found.groupBy(*PAGE).agg(
        F.min("confidence").alias("region_min"), F.count(F.lit(1)).alias("regions"), F.coalesce(F.max("column_count"), F.lit(1)).alias("columns"),
        F.count_distinct(F.when(F.col("kind_hint") == "column", F.col("band_index"))).alias("structural"),
        *[F.max((F.col("kind_hint") == k).cast("int")).alias("has_" + k) for k in ("table", "figure", "callout")],
    )
    o = order.groupBy(*PAGE).agg(F.min("confidence").alias("order_min"), F.count(F.lit(1)).alias("ordered"))
    both = r.join(o, list(PAGE), "left").join(page_furniture.select(*PAGE, "furniture_fraction"), list(PAGE), "left")
    # Weights of the signals.
    lost = (
        (1 - F.col("region_min")) * 0.25
        + (1 - F.coalesce("order_min", F.lit(1.0))) * 0.25
        + (F.col("regions") - F.coalesce("ordered", F.lit(0)) - F.col("structural")) / F.col("regions") * 0.15
        + F.when(F.col("columns") <= 1, 0.0).when(F.col("columns") == 2, 0.3).otherwise(0.6) * 0.15
        + (F.col("has_table") + F.col("has_figure") + F.col("has_callout")) * 0.2 * 0.1
        + F.least(F.greatest(F.coalesce("furniture_fraction", F.lit(0.0)) - 0.5, F.lit(0.0)) * 2, F.lit(1.0)) * 0.1
    )
    return both.withColumn("confidence", g.clamp(1 - lost)).withColumn("route", F.when(F.col("confidence") >= 0.6, "semantic").when(F.col("confidence") >= 0.3, "hybrid").otherwise("facsimile"))
