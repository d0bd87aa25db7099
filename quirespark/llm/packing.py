"""Problem 1: items of varying length into containers of fixed capacity.

First-fit decreasing: items in falling order of length, each into the first
container that still has room.  A tournament tree over the room left in the
containers finds that container in O(log n).  A rulebook is cut into randomised
groups of bounded size which are packed apart, so that the largest rulebook is
spread over as many tasks as it needs; a group wastes at most the room of its
last containers, which is little against a group of ``GROUP_ITEMS`` items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Aim for the number of items in a group.
GROUP_ITEMS = 20_000


class Tournament:
    """Room left in containers; ``place`` takes the first one with room enough."""

    def __init__(self, capacity: int, expected: int) -> None:
        self.capacity = capacity
        self.leaves = 1
        while self.leaves < max(1, expected):
            self.leaves *= 2
        self.room = [capacity] * (2 * self.leaves)
        self.used = 0

    def place(self, size: int, count: int = 1) -> tuple[int, int]:
        """Container that takes ``size`` first, and how many of ``count`` such items it takes; containers are opened in order."""
        if self.room[1] < size:
            self._grow()
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        index = at - self.leaves
        self.used = max(self.used, index + 1)
        # The first container with room stays the first until it is too full for another one.
        taken = min(count, room[at] // size) if size else count
        room[at] -= taken * size
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
        return index, taken

    def _grow(self) -> None:
        old, n = self.room[self.leaves :], self.leaves
        self.leaves = 2 * n
        self.room = [0] * self.leaves + old + [self.capacity] * n
        for at in range(self.leaves - 1, 0, -1):
            self.room[at] = max(self.room[2 * at], self.room[2 * at + 1])


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container of each item; no size may exceed ``capacity``.  Ties keep the given order."""
    sizes = np.asarray(sizes, np.int64)
    tree = Tournament(capacity, int(sizes.sum()) // max(1, capacity) + 1)
    order = np.argsort(-sizes, kind="stable")
    ranked = sizes[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    place = np.zeros(len(sizes), np.int64)
    for head, size, count in zip(heads.tolist(), ranked[heads].tolist(), np.diff(np.append(heads, len(ranked))).tolist()):
        at, end = head, head + count
        while at < end:
            index, taken = tree.place(size, end - at)
            place[order[at : at + taken]] = index
            at += taken
    return place


def requests(chars: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Item, part, offset and size of all pieces, request after request, and the number of pieces of each request.

    An item longer than ``capacity`` gives full pieces, each a request of its own
    behind the others, and a rest that is packed like an item.
    """
    whole = np.where(chars > capacity, -(-chars // capacity) - 1, 0)
    offset = whole * capacity
    rest = chars - offset
    place = first_fit_decreasing(rest, capacity)
    order = np.argsort(place, kind="stable")
    long = np.repeat(np.arange(len(chars)), whole)
    number = np.arange(len(long)) - np.repeat(np.cumsum(whole) - whole, whole)
    item = np.concatenate([order, long])
    part = np.concatenate([whole[order] + 1, number + 1])
    begin = np.concatenate([offset[order], number * capacity])
    size = np.concatenate([rest[order], np.full(len(long), capacity, np.int64)])
    return item, part, begin, size, np.concatenate([np.bincount(place) if len(place) else place, np.ones(len(long), np.int64)])


def pack(units: DataFrame, limits: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Requests of each rulebook under each limit, one row a request.

    ``doc_id, limit_id, group_no, request_no, used_chars, free_chars, nodes``
    with ``nodes ARRAY<STRUCT<unit_id, inline_id, part, offset, chars>>``.  Every
    node is in exactly one request; a node longer than the capacity is divided
    into full requests (``part`` from 1) and a rest that is packed like a node.
    Repeated unit rows count once (by ``unit_id``).  NULL and empty texts are
    nodes of length 0; NULL nodes, units without nodes and limits without a
    positive capacity are left out; repeated limits count once.  Empty tables give
    no rows.  Extra columns are not read.
    """
    once = (
        units.select("unit_id", "doc_id", F.transform("text_nodes", lambda n: F.struct(n["inline_id"].alias("inline_id"), F.coalesce(F.length(n["source_text"]), F.lit(0)).alias("chars"), n.isNull().alias("none"))).alias("nodes"))
        .groupBy("unit_id", "doc_id")
        .agg(F.max("nodes").alias("nodes"))
    )
    items = once.select("doc_id", "unit_id", F.posexplode("nodes").alias("ord", "n")).where(~F.col("n.none")).select("doc_id", "unit_id", "ord", "n.inline_id", "n.chars")
    groups = items.groupBy(F.col("doc_id").alias("book")).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / group_items)).alias("groups"))
    spread = items.join(groups, F.col("doc_id").eqNullSafe(F.col("book"))).withColumn("group_no", F.pmod(F.xxhash64("unit_id", "inline_id", "ord"), "groups").cast("int"))
    caps = sorted({(r["limit_id"], r["capacity_chars"]) for r in limits.where(F.col("capacity_chars") > 0).select("limit_id", "capacity_chars").distinct().collect()}, key=repr)
    # A group is of bounded size; its strings stay in Arrow, only lengths and places are worked on.
    grouped = spread.groupBy("doc_id", "group_no").agg(F.sort_array(F.collect_list(F.struct("unit_id", "ord", "inline_id", "chars"))).alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                items = batch.column(2).slice(k, 1).flatten()
                unit, inline = items.field(0), items.field(2)
                chars = items.field(3).to_numpy(zero_copy_only=False).astype(np.int64)
                for limit, cap in caps:
                    item, part, begin, size, counts = requests(chars, cap)
                    n = len(counts)
                    ends = np.cumsum(counts)
                    used = np.add.reduceat(size, ends - counts) if n else counts
                    at = pa.array(item, pa.int64())
                    nodes = pa.StructArray.from_arrays([unit.take(at), inline.take(at), *(pa.array(x, pa.int32()) for x in (part, begin, size))], ["unit_id", "inline_id", "part", "offset", "chars"])
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), nodes)
                    same = [batch.column(0).slice(k, 1).take(pa.array(np.zeros(n, np.int64))), pa.array([limit] * n, pa.string()), batch.column(1).slice(k, 1).take(pa.array(np.zeros(n, np.int64)))]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(n), pa.int32()), pa.array(used, pa.int32()), pa.array(cap - used, pa.int32()), lists], NAMES)

    return grouped.mapInArrow(run, SCHEMA)


NAMES = ["doc_id", "limit_id", "group_no", "request_no", "used_chars", "free_chars", "nodes"]
SCHEMA = "doc_id string, limit_id string, group_no int, request_no int, used_chars int, free_chars int, nodes array<struct<unit_id: string, inline_id: string, part: int, offset: int, chars: int>>"


def totals(requests: DataFrame, limits: DataFrame) -> DataFrame:
    """What holds of :func:`pack`'s result however well it packs, a row a rulebook and limit.

    ``doc_id, limit_id, nodes, pieces, chars, over, least_requests, enough``: nodes
    and pieces in requests, all characters, requests above the capacity, the
    number that no packing can undercut, and whether there are so many.
    """
    size = limits.where(F.col("capacity_chars") > 0).select(F.col("limit_id").alias("__limit"), "capacity_chars").distinct()
    sums = requests.groupBy("doc_id", "limit_id").agg(
        F.sum(F.size(F.filter("nodes", lambda n: n["offset"] == 0))).alias("nodes"),
        F.sum(F.size("nodes")).alias("pieces"),
        F.sum(F.col("used_chars").cast("bigint")).alias("chars"),
        F.sum((F.col("free_chars") < 0).cast("int")).alias("over"),
        F.count(F.lit(1)).alias("n"),
    )
    least = F.ceil(F.col("chars") / F.col("capacity_chars")).cast("bigint")
    return sums.join(size, F.col("limit_id").eqNullSafe(F.col("__limit"))).select("doc_id", "limit_id", "nodes", "pieces", "chars", "over", least.alias("least_requests"), (F.col("n") >= least).alias("enough"))


#: The same totals from the nodes themselves.
TOTALS_SQL = """
WITH once AS (SELECT unit_id, doc_id, max(text_nodes) AS nodes FROM translation_units GROUP BY unit_id, doc_id),
n AS (SELECT doc_id, unnest(nodes) AS node FROM once),
c AS (SELECT doc_id, coalesce(length(node.source_text), 0) AS chars FROM n WHERE node IS NOT NULL),
l AS (SELECT DISTINCT limit_id, capacity_chars AS cap FROM request_limits WHERE capacity_chars > 0)
SELECT doc_id, limit_id, count(*) AS nodes, sum(greatest(1, CAST(ceil(chars / cap) AS BIGINT)))::BIGINT AS pieces, sum(chars)::BIGINT AS chars, 0::BIGINT AS over,
  CAST(ceil(sum(chars) / max(cap)) AS BIGINT) AS least_requests, TRUE AS enough
FROM c, l GROUP BY doc_id, limit_id
"""
