"""Problem 6: lines that return over and over within one group of documents.

Three passes.  The first builds, for each group (a source or a rulebook), a
mergeable heavy-hitter summary in every map task: counters of line keys that may
be thinned as long as the counts lost stay under a tenth of the group's
documents in the task, so that after the merge a line can have been
underestimated by a tenth of all documents at most.  With a threshold of a fifth,
every line that reaches the threshold is left as a candidate.  The second pass
counts the candidates exactly; the third marks the lines that were confirmed.
Candidates and confirmed lines are broadcast after a check of their number, and
joined through a shuffle of their keys beyond it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, spread

SHARE = 0.2
LEAST = 3
#: Counters of one group in one task above which thinning is tried.
CAPACITY = 2048
#: Keys that may be broadcast (16 to 60 bytes each).
BROADCAST_KEYS = 200_000


def letters(text: Column) -> Column:
    """The letters of each line of a text in lower case; NULL counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\n]+", "")


def has_letters(key: Column) -> Column:
    """False for the key of a line without letters."""
    return key != F.xxhash64(F.lit(""))


def _thin(counts: Counter, spare: float) -> float:
    """Drop the rarest counters while what any of them held stays within ``spare``."""
    order = Counter(counts.values())
    lost, left = 0, len(counts)
    for n in sorted(order):
        if n > spare or left <= CAPACITY // 2:
            break
        lost, left = n, left - order[n]
    if lost:
        for k in [k for k, n in counts.items() if n <= lost]:
            del counts[k]
    return lost


def summaries(keyed: DataFrame, share: float = SHARE) -> DataFrame:
    """``grp, key, n`` with a row of NULL key for the documents (``n``) of the task.

    ``keyed(grp, keys)`` has the distinct line keys of each document.  A counter
    that was thinned away and returns starts anew; the sum of all losses of a
    group in a task is bounded by ``share / 2`` of its documents there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        docs: Counter = Counter()
        lost: Counter = Counter()
        limit: dict[str, int] = {}
        for batch in batches:
            for grp, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs[grp] += 1
                own = counts.get(grp)
                if own is None:
                    own, limit[grp] = counts.setdefault(grp, Counter()), CAPACITY
                own.update(keys or ())
                if len(own) > limit[grp]:
                    lost[grp] += _thin(own, share / 2 * docs[grp] - lost[grp])
                    limit[grp] = max(CAPACITY, 2 * len(own))
        for grp, own in counts.items():
            least = share / 2 * docs[grp] - lost[grp]
            kept = [(k, n) for k, n in own.items() if n > least]
            yield pa.RecordBatch.from_arrays(
                [pa.array([grp] * (len(kept) + 1), pa.string()), pa.array([None] + [k for k, _ in kept], pa.int64()), pa.array([docs[grp]] + [n for _, n in kept], pa.int64())],
                ["grp", "key", "n"],
            )

    return keyed.select("grp", "keys").mapInArrow(run, "grp string, key bigint, n bigint")


def _pair(df: DataFrame, keys: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Inner join with unique ``keys``: broadcast where their number allows it."""
    return df.join(F.broadcast(keys) if small else keys.hint("merge"), on)


def repeated_lines(lines: DataFrame, keyed: DataFrame, totals: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """The rows of ``lines(grp, doc, item, key)`` whose key is on enough documents.

    ``keyed(grp, keys)`` has one row a document with its distinct keys and
    ``totals(grp, docs)`` the number of documents of each group.  A line counts
    where its key stands in at least ``share`` of the documents and in at least
    ``least``.  Rows without key, and groups that are NULL, must have been left
    out of ``lines``.  Empty tables give no rows.
    """
    confirmed, hits, small = _confirmed(lines, keyed, totals, share, least)
    return _pair(hits, confirmed, ["grp", "key"], small).select("grp", "doc", "item")


def _confirmed(lines: DataFrame, keyed: DataFrame, totals: DataFrame, share: float, least: int) -> tuple[DataFrame, DataFrame, bool]:
    """The confirmed keys of each group, the rows that hold a candidate, and whether keys are few enough to be broadcast."""
    ensure_checkpoint_dir(lines.sparkSession)
    merged = summaries(keyed, share).groupBy("grp", "key").agg(F.sum("n").alias("n"))
    candidates = (
        merged.where(F.col("key").isNotNull())
        # A group of fewer documents than a line must be in has no such line.
        .join(totals.where(F.col("docs") >= least), "grp")
        .where(F.col("n") + share / 2 * F.col("docs") >= share * F.col("docs"))
        .select("grp", "key", "docs")
        .checkpoint()
    )
    small = candidates.count() <= BROADCAST_KEYS
    hits = _pair(lines, candidates, ["grp", "key"], small).checkpoint()
    once = hits.groupBy("grp", "key", "docs", "doc").agg(F.lit(1).alias("one"))
    exact = once.groupBy("grp", "key", "docs").agg(F.sum("one").alias("n"))
    confirmed = exact.where((F.col("n") >= least) & (F.col("n") >= share * F.col("docs") - 1e-9)).select("grp", "key")
    return confirmed.checkpoint(), hits, small


def page_lines(primitives: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``record_kind, doc_key, item_key`` of the furniture rows of each rulebook.

    A page counts where the rulebook has any row for it, NULL texts included.
    Repeated rows count once; rows with NULL key columns are left out.
    """
    p = spread(primitives.select("doc_id", "page_number", "primitive_id", "text").where(F.col("doc_id").isNotNull()))
    p = p.withColumn("key", F.xxhash64(F.replace(letters(F.col("text")), F.lit("\n"), F.lit("")))).select(F.col("doc_id").alias("grp"), F.col("page_number").alias("page"), F.col("primitive_id").alias("item"), "key")
    pages = p.groupBy("grp", "page").agg(F.collect_set(F.when(has_letters(F.col("key")), F.col("key"))).alias("keys"))
    totals = p.groupBy("grp").agg(F.count_distinct("page").alias("docs"))
    lines = p.where(has_letters(F.col("key")) & F.col("item").isNotNull()).select("grp", F.col("page").cast("string").alias("doc"), "item", "key")
    found = repeated_lines(lines, pages.where(F.col("page").isNotNull()), totals, share, least)
    return found.select(F.lit("page_line").alias("record_kind"), F.col("grp").alias("doc_key"), F.col("item").alias("item_key")).distinct()


def _of_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``lines``, ``keyed`` and ``totals`` of :func:`repeated_lines` for the sources of documents."""
    d = spread(documents.where(F.col("source").isNotNull()).select("source", "doc_id", "text"))
    keyed = d.select(F.col("source").alias("grp"), "doc_id", line_keys(F.col("text")).alias("all"))
    lines = keyed.select("grp", F.col("doc_id").cast("string").alias("doc"), F.posexplode("all").alias("pos", "key")).where(has_letters(F.col("key")))
    lines = lines.select("grp", "doc", F.concat_ws(":", "doc", F.col("pos") + 1).alias("item"), "key")
    totals = d.groupBy(F.col("source").alias("grp")).agg(F.count(F.lit(1)).alias("docs"))
    return lines, keyed.select("grp", F.array_remove(F.array_distinct("all"), F.xxhash64(F.lit(""))).alias("keys")), totals


def line_keys(text: Column) -> Column:
    """A key for each line of a text."""
    return F.transform(F.split(letters(text), "\n", -1), lambda line: F.xxhash64(line))


def document_lines(documents: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``record_kind, doc_key, item_key`` (``doc_id:line number``) of each source's boilerplate.

    Documents with NULL or empty text count; NULL sources are left out.
    """
    found = repeated_lines(*_of_documents(documents), share, least)
    return found.select(F.lit("document_line").alias("record_kind"), F.col("grp").alias("doc_key"), F.col("item").alias("item_key"))


def strip_repeated(documents: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``documents`` with the repeated lines of each source removed from ``text``.

    Each source has a set of confirmed lines, of at most ``1 / share`` times the
    lines of a document, which is joined to its documents: documents are not
    shuffled where the sets are broadcast, which is decided by their number.
    Documents of sources without such lines, NULL texts and sources stay as they are.
    """
    confirmed, _, small = _confirmed(*_of_documents(documents), share, least)
    sets = confirmed.groupBy(F.col("grp").alias("__source")).agg(F.collect_set("key").alias("__gone"))
    both = documents.join(F.broadcast(sets) if small else sets, F.col("source") == F.col("__source"), "left")
    pairs = F.arrays_zip(F.split("text", "\n", -1).alias("line"), line_keys(F.col("text")).alias("key"))
    kept = F.transform(F.filter(pairs, lambda x: ~F.array_contains(F.col("__gone"), x["key"])), lambda x: x["line"])
    text = F.when(F.col("__gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return both.withColumn("text", text).drop("__source", "__gone")


#: The same lines by exact counting, as SQL for the check of the small tables.
FOUND_SQL = """
WITH pl AS (SELECT DISTINCT doc_id, page_number, primitive_id, regexp_replace(lower(text), '[^\\p{L}]+', '', 'g') AS k FROM text_primitives WHERE doc_id IS NOT NULL),
pt AS (SELECT doc_id, count(DISTINCT page_number) AS n FROM pl GROUP BY doc_id),
pk AS (SELECT doc_id, k, count(DISTINCT page_number) AS c FROM pl WHERE k <> '' GROUP BY doc_id, k),
dl AS (SELECT source, doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, regexp_replace(lower(unnest(string_split(text, chr(10)))), '[^\\p{L}]+', '', 'g') AS k FROM documents WHERE source IS NOT NULL),
dt AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
dk AS (SELECT source, k, count(DISTINCT doc_id) AS c FROM dl WHERE k <> '' GROUP BY source, k)
SELECT 'page_line' AS record_kind, pl.doc_id AS doc_key, pl.primitive_id AS item_key
FROM pl JOIN pk ON pk.doc_id = pl.doc_id AND pk.k = pl.k JOIN pt ON pt.doc_id = pl.doc_id
WHERE pk.c >= 3 AND pk.c * 5 >= pt.n
UNION ALL
SELECT 'document_line', dl.source, dl.doc_id || ':' || dl.i
FROM dl JOIN dk ON dk.source = dl.source AND dk.k = dl.k JOIN dt ON dt.source = dl.source
WHERE dk.c >= 3 AND dk.c * 5 >= dt.n
"""

#: Documents without those lines.
STRIPPED_SQL = """
WITH dl AS (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
k AS (SELECT *, regexp_replace(lower(line), '[^\\p{L}]+', '', 'g') AS k FROM dl),
dt AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source),
dk AS (SELECT k.source, k, count(DISTINCT doc_id) AS c FROM k WHERE k <> '' AND source IS NOT NULL GROUP BY k.source, k),
gone AS (SELECT dk.source, k FROM dk JOIN dt ON dt.source = dk.source WHERE c >= 3 AND c * 5 >= n)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone.k IS NULL), '') AS text
FROM k LEFT JOIN gone ON gone.source = k.source AND gone.k = k.k GROUP BY doc_id
UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL
"""
