"""Navigation, search documents, summaries and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t


def carried(rows: DataFrame, value, *order: str, name: str) -> DataFrame:
    """Adds the last non-NULL ``value`` up to each row of its document, in the order of ``page_number`` and then ``order``.

    The last of a page is found within the page and carried on over pages, so that
    only a row a page of a document comes together in one place.
    """
    page = Window.partitionBy("doc_id", "page_number").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("__v", value).withColumn("__own", F.last("__v", ignorenulls=True).over(page))
    last = marked.groupBy("doc_id", "page_number").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))).alias("__v"))
    over = Window.partitionBy("doc_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    pages = last.select(F.col("doc_id").alias("__d"), F.col("page_number").alias("__p"), F.last("__v", ignorenulls=True).over(over).alias("__before"))
    both = marked.join(pages, F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("page_number").eqNullSafe(F.col("__p")))
    return both.withColumn(name, F.coalesce("__own", "__before")).drop("__v", "__own", "__before", "__d", "__p")


def nest(entries: DataFrame) -> DataFrame:
    """Adds ``parent``: the last entry of level 1 before an entry of a deeper level, across pages; orphans have none."""
    top = carried(entries, F.when(F.col("nav_level") == 1, F.col("anchor_id")), "anchor_id", name="__top")
    return top.withColumn("parent", F.when(F.col("nav_level") > 1, F.col("__top"))).drop("__top")


def navigation(page_blocks: DataFrame) -> DataFrame:
    """Entries of the headings that are no lines of a table of contents: ``doc_id, page_number, anchor_id, label, nav_level, parent``."""
    h = page_blocks.where((F.col("kind") == "heading") & ~t.is_contents_entry(F.col("content")))
    entries = h.select("doc_id", "page_number", F.col("block_id").alias("anchor_id"), F.col("content").alias("label"), F.coalesce("level", F.lit(2)).alias("nav_level"))
    return nest(entries)


def search_documents(page_blocks: DataFrame) -> DataFrame:
    """One row a block with text: its heading (carried across pages) and its section path (anew on each page, itself included)."""
    head = (F.col("kind") == "heading").cast("int")
    by_page = Window.partitionBy("doc_id", "page_number").orderBy("block_ord").rowsBetween(Window.unboundedPreceding, 0)
    headed = carried(page_blocks, F.when(head == 1, F.col("content")), "block_ord", name="heading")
    marked = headed.withColumns({"__sec": F.sum(F.when((head == 1) & (F.col("level") == 1), 1).otherwise(0)).over(by_page)})
    in_sec = Window.partitionBy("doc_id", "page_number", "__sec").orderBy("block_ord").rowsBetween(Window.unboundedPreceding, 0)
    path = F.collect_list(F.when(F.col("kind") == "heading", F.col("content"))).over(in_sec)
    return marked.withColumn("section_path", path).where((F.trim(F.coalesce("content", F.lit(""))) != "") & (F.col("kind") != "list")).select("doc_id", "page_number", "block_id", "kind", "content", "heading", "section_path")


def coverage(runs: DataFrame) -> DataFrame:
    """Share of each document's texts that have a translation; blank texts do not count; 0 where there are none."""
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    return runs.groupBy("doc_id").agg(F.count_if(~blank).alias("texts"), F.count_if(~blank & (F.coalesce("ru_text", F.lit("")) != "")).alias("translated")).withColumn("coverage", F.when(F.col("texts") > 0, F.col("translated") / F.col("texts")).otherwise(0.0))


def index_manifest(documents: DataFrame) -> DataFrame:
    """Totals of the search documents of each document and their number by kind."""
    by_kind = documents.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    kinds = by_kind.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "kind", F.col("n").cast("string")))), ",").alias("kinds"), F.sum("n").alias("total"))
    pages = documents.groupBy("doc_id").agg(F.count_distinct("page_number").alias("pages"))
    return kinds.join(pages, "doc_id")


def search(documents: DataFrame, query: str, limit: int = 10, key: str = "block_id", text: str = "content") -> DataFrame:
    """Best ``limit`` documents for a query by BM25 (an extension: the ranking of a search library is not part of the domain).

    A blank query finds nothing.  Only the words of the query are counted, and the
    limit is a top-k.
    """
    words = sorted({w for w in query.lower().split() if w})
    toks = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    d = documents.select(F.col(key).alias("key"), toks.alias("toks")).withColumn("len", F.size("toks"))
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("avg"))
    hits = d.select("key", "len", F.explode("toks").alias("w")).where(F.col("w").isin(*words) if words else F.lit(False)).groupBy("key", "len", "w").agg(F.count(F.lit(1)).alias("tf"))
    df = hits.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    both = hits.join(df, "w").select("*", stats.select(F.struct("n", "avg")).scalar().alias("__s")).select("key", "len", "w", "tf", "df", "__s.n", "__s.avg")
    score = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * 2.2 / (F.col("tf") + 1.2 * (0.25 + 0.75 * F.col("len") / F.col("avg")))
    return both.groupBy("key").agg(F.sum(score).alias("score")).orderBy(F.desc("score"), "key").limit(limit)


def document_summary(localized: DataFrame) -> DataFrame:
    """``doc_id, page_count, block_count, heading_count, coverage`` of each document; lists and tables do not count for the coverage."""
    own = localized.groupBy("doc_id").agg(F.count_distinct("page_number").cast("int").alias("page_count"), F.count(F.lit(1)).alias("block_count"), F.count_if(F.col("kind") == "heading").alias("heading_count"))
    done = coverage(localized.where(~F.col("kind").isin("list", "table", "figure")).select("doc_id", F.col("content").alias("text"), "ru_text"))
    return own.join(done.select("doc_id", "coverage"), "doc_id", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))
