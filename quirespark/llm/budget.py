"""Problem 3: tokens per rulebook and per (source, lang, topic) slice.

Whole texts are reduced to a 128-bit hash; one text of each hash is tokenised,
and its exact count is joined back to the number of times that the hash occurs
in each slice.  A text that makes up a third of the corpus crosses the shuffle
once a map task, because both sides are aggregated before they are exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import pieces
from .bpe import worker_encoder
from .encoding import TOKENIZERS, VOCABULARY, rank_file


def text_hash(text: Column) -> Column:
    """128 bits of two differently seeded hashes of a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def token_counts(texts: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``h`` and ``tokens`` for ``texts(h, text)`` with one row a hash."""
    ranks = rank_file(texts.sparkSession, tokenizers, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(ranks.value)
        for batch in batches:
            for part in pieces(batch, (1,)):
                counts = encoder.count_batch([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], ["h", "tokens"])

    return texts.select("h", "text").mapInArrow(run, "h struct<a: bigint, b: bigint>, tokens bigint")


def token_budget(documents: DataFrame, units: DataFrame, estimates: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each rulebook of ``units`` and each slice of ``documents``.

    ``kind`` is ``rulebook`` (``doc_id`` set) or ``slice`` (``source``, ``lang``,
    ``topic`` as they stand, NULL being a value of its own).  ``texts`` counts
    documents or text nodes, ``distinct_texts`` those that differ within the
    slice, ``tokens`` all of them with their multiplicity.  NULL and empty texts
    count as texts of no tokens.  Repeated unit rows (same ``unit_id``) count
    once; a unit without nodes still names its rulebook.
    ``estimated_input_tokens`` is the estimate of the rulebook's latest run
    (largest ``run_id``) that has one, else NULL.  Empty tables give no rows.
    """
    docs = documents.select("source", "lang", "topic", "text").withColumn("h", text_hash(F.coalesce("text", F.lit(""))))
    nodes = (
        units.select("unit_id", "doc_id", F.col("text_nodes.source_text").alias("texts"))
        .withColumn("hs", F.transform("texts", lambda t: text_hash(F.coalesce(t, F.lit("")))))
    )
    once = nodes.groupBy("unit_id", "doc_id").agg(F.max("hs").alias("hs"))
    by_book = once.select("doc_id", F.explode_outer("hs").alias("h")).groupBy("doc_id", "h").agg(F.count("h").alias("n"))
    by_slice = docs.groupBy("source", "lang", "topic", "h").agg(F.count(F.lit(1)).alias("n"))
    of = lambda df, kind, cols: df.select(F.lit(kind).alias("kind"), *[(F.col(c) if c in cols else F.lit(None).cast("string")).alias(c) for c in ("doc_id", "source", "lang", "topic")], "h", "n")
    times = of(by_book, "rulebook", ("doc_id",)).unionByName(of(by_slice, "slice", ("source", "lang", "topic")))

    texts = docs.select("h", "text").unionByName(nodes.select(F.explode(F.arrays_zip("hs", "texts")).alias("z")).select(F.col("z.hs").alias("h"), F.col("z.texts").alias("text")))
    distinct = texts.where(F.length("text") > 0).groupBy("h").agg(F.first("text").alias("text"))
    counts = token_counts(distinct, tokenizers, vocabulary)

    totals = (
        times.join(counts, "h", "left")
        .groupBy("kind", "doc_id", "source", "lang", "topic")
        .agg(F.sum("n").alias("texts"), F.count("h").alias("distinct_texts"), F.sum(F.coalesce("tokens", F.lit(0)) * F.col("n")).alias("tokens"))
    )
    latest = (
        estimates.where(F.col("estimated_input_tokens").isNotNull())
        .groupBy(F.col("doc_id").alias("book"))
        .agg(F.max_by("estimated_input_tokens", F.struct("run_id", "estimated_input_tokens")).alias("estimated_input_tokens"))
    )
    return totals.join(latest, (F.col("kind") == "rulebook") & (F.col("doc_id") == F.col("book")), "left").drop("book")


#: What of the result SQL can count.
TEXTS_SQL = """
WITH once AS (SELECT unit_id, doc_id, max(text_nodes) AS nodes FROM translation_units GROUP BY unit_id, doc_id),
n AS (SELECT doc_id, coalesce(x.source_text, '') AS t FROM (SELECT doc_id, unnest(nodes) AS x FROM once)),
latest AS (SELECT doc_id, max_by(estimated_input_tokens, {'r': run_id, 'e': estimated_input_tokens}) AS e FROM cost_estimates WHERE estimated_input_tokens IS NOT NULL GROUP BY doc_id),
books AS (SELECT b.doc_id, count(t) AS texts, count(DISTINCT t) AS distinct_texts FROM (SELECT DISTINCT doc_id FROM once) b LEFT JOIN n ON n.doc_id IS NOT DISTINCT FROM b.doc_id GROUP BY b.doc_id)
SELECT 'rulebook' AS kind, b.doc_id, NULL::VARCHAR AS source, NULL::VARCHAR AS lang, NULL::VARCHAR AS topic, texts, distinct_texts, e AS estimated_input_tokens
FROM books b LEFT JOIN latest l ON l.doc_id = b.doc_id
UNION ALL
SELECT 'slice', NULL, source, lang, topic, count(*), count(DISTINCT coalesce(text, '')), NULL FROM documents GROUP BY source, lang, topic
"""
