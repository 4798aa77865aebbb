"""Minimax contiguous partition of ordered, atomic groups into shards.

Groups are rows with equal texts, and a group is never cut. A group larger than an even
share of what is left comes first in the order and gets a shard of its own, so that it
cannot raise the capacity of the others; the rest is ordered by the digest of the text
(rows within a group by id). The answer for the rest is the smallest capacity with which a greedy
walk over the group sizes needs no more than the wanted shards, found by binary search;
the walk at that capacity gives the cuts.

The walk only asks for group ends near its cut positions. The driver therefore holds a
coarse set of ends (at most ``RESOLUTION`` per round) and bounds the capacity from both
sides: a walk that may cut only at known ends needs at least the true capacity, one that
may also cut anywhere in a stretch of unknown ends needs at most it. Each round fetches
the ends that lie where the two walks can differ, until both give the same number. Sizes
and ends come from running sums over range partitions; no task holds more than one range,
and a group of any share of the rows spreads over ranges by id.

Nulls: a null text has no bytes and is in one group with empty texts; a null id sorts
first. Repeated rows get slots of their own in any order. An empty table gives no rows;
with fewer groups than shards the last shards stay empty. Only id and text are read, so
other columns do not matter. ``size`` of a row is its UTF-8 bytes plus ``overhead``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscape.llm.common import partitions, shared_dir, stored, text_or_empty

RESOLUTION = 50_000


class Ends:
    """Known group ends (running sums, sorted), and for each whether the stretch before
    it holds ends that are not known."""

    def __init__(self, total: int):
        self.at = np.asarray([total], np.int64)
        self.open_before = np.asarray([True])

    def walk(self, capacity: int, optimistic: bool) -> list[int]:
        """Greedy cut positions; the last is the total, or the walk stops short of it."""
        cuts, pos, total = [], 0, int(self.at[-1])
        while pos < total:
            limit = pos + capacity
            i = int(np.searchsorted(self.at, limit, side="right"))
            to = int(self.at[i - 1]) if i else 0
            if optimistic and i < len(self.at) and self.open_before[i]:
                to = limit
            if to <= pos:
                break
            cuts.append(to)
            pos = to
        return cuts

    def least(self, shards: int, low: int, optimistic: bool) -> int:
        """Binary search for the smallest capacity that needs at most ``shards``."""
        total = int(self.at[-1])
        high = max(total, low)
        while low < high:
            mid = (low + high) // 2
            cuts = self.walk(mid, optimistic)
            if cuts and cuts[-1] >= total and len(cuts) <= shards:
                high = mid
            else:
                low = mid + 1
        return low

    def doubtful(self, shards: int, low: int, high: int) -> list[tuple[int, int]]:
        """Open stretches in which a cut can lie for a capacity from low to high."""
        early, late = self.walk(low, False), self.walk(high, True)
        total, ranges = int(self.at[-1]), []
        for j in range(shards):
            a = early[j] if j < len(early) else (early[-1] if early else 0)
            b = late[j] if j < len(late) else total
            for i in range(int(np.searchsorted(self.at, a, "left")), min(int(np.searchsorted(self.at, b, "left")) + 1, len(self.at))):
                if self.open_before[i]:
                    ranges.append((int(self.at[i - 1]) if i else 0, int(self.at[i])))
        return sorted(set(ranges))

    def learn(self, asked: list[tuple[int, int]], pieces: list[tuple[int, int, int]]) -> None:
        """Add the first and last end of pieces of the asked stretches, which hold n ends
        each; only between those two can more lie."""
        for _, b in asked:
            self.open_before[np.searchsorted(self.at, b)] = False
        known = dict(zip(self.at.tolist(), self.open_before.tolist(), strict=True))
        for first, last, n in pieces:
            known[first] = False
            known[last] = n > 2
        self.at = np.asarray(sorted(known), np.int64)
        self.open_before = np.asarray([known[int(e)] for e in self.at])


def minimax_cuts(groups: DataFrame, shards: int, resolution: int = RESOLUTION) -> tuple[int, list[int]]:
    """``groups`` has ``end``, the running sum at each group's end, and ``size``.
    Returns the capacity and the running sums after which to cut (the total is last)."""
    groups = groups.filter("size > 0")  # a group without size belongs to the end before it
    top = groups.agg(F.max("end"), F.max("size")).first()
    if top[0] is None:
        return 0, []
    ends = Ends(top[0])
    low, high, asked = top[1], top[0], [(0, top[0])]
    while asked:
        pieces = max(2, resolution // len(asked))  # of every stretch, so that each round gets on
        found = (
            _inside(groups, asked, pieces)
            .groupBy("stretch", "piece")
            .agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n"))
            .select("first", "last", "n")
        )
        ends.learn(asked, [tuple(r) for r in found.collect()])
        low = max(low, ends.least(shards, low, True))
        high = ends.least(shards, low, False)
        if low == high:
            break
        asked = ends.doubtful(shards, low, high)
    return high, ends.walk(high, False)


def _inside(groups: DataFrame, asked: list[tuple[int, int]], pieces: int) -> DataFrame:
    """Groups whose end lies in one of few sorted, disjoint stretches, with the number of
    the stretch and of the piece of it."""
    starts, stops = F.lit([a for a, _ in asked]), F.lit([b for _, b in asked])
    steps = F.lit([max(1, -(-(b - a) // pieces)) for a, b in asked])
    n = F.size(F.filter(starts, lambda a: a < F.col("end"))) - 1  # the last stretch that starts before the end
    inside = groups.withColumn("stretch", n).filter((F.col("stretch") >= 0) & (F.col("end") <= F.get(stops, F.col("stretch"))))
    at = F.col("end") - F.get(starts, F.col("stretch")) - 1
    return inside.withColumn("piece", F.floor(at / F.get(steps, F.col("stretch"))))


def oversized(sizes: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Digest and size of the groups larger than an even share of what is left for the
    shards still free, largest first; fewer than ``shards`` of them."""
    groups = sizes.groupBy("digest").agg(F.sum("size").alias("size"))
    left, out = sizes.agg(F.sum("size")).first()[0] or 0, []
    for digest, size in groups.orderBy(F.desc("size"), "digest").limit(shards - 1).collect():
        if size * (shards - len(out)) <= left:
            break
        out.append((bytes(digest), size))
        left -= size
    return out


def running(docs: DataFrame, shards: int, path: str, id_col: str, text: str, overhead: int) -> tuple[DataFrame, list[int]]:
    """id, size, text_crc32, digest, ``own`` (the number of an oversized group, or how many
    there are), ``row`` (from 0) and ``upto``, the running sum of sizes, over all rows in the
    order of own, digest and id; and the sizes of the oversized groups."""
    spark = docs.sparkSession
    t = text_or_empty(F.col(f"`{text}`"))
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(t).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(t).alias("text_crc32"),
        F.unhex(F.sha2(t, 256)).alias("digest"),
    )
    narrow = stored(narrow, f"{path}/sizes")
    large = oversized(narrow, shards)
    own = F.coalesce(*[F.when(F.col("digest") == F.lit(d), i) for i, (d, _) in enumerate(large)], F.lit(len(large)))
    narrow = narrow.withColumn("own", own)
    order = [F.col("own"), F.col("digest"), F.col("id").asc_nulls_first()]
    ranges = narrow.repartitionByRange(partitions(spark), *order).withColumn("pid", F.spark_partition_id())
    ranges = stored(ranges, f"{path}/ranges")
    totals = sorted(ranges.groupBy("pid").agg(F.count("*"), F.sum("size")).collect())
    rows_before, size_before = [0] * (totals[-1][0] + 2 if totals else 1), [0] * (totals[-1][0] + 2 if totals else 1)
    for pid, n, s in totals:
        rows_before[pid + 1], size_before[pid + 1] = n, s
    rows_before, size_before = np.cumsum(rows_before).tolist(), np.cumsum(size_before).tolist()
    w = Window.partitionBy("pid").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    placed = ranges.select(
        "*",
        (F.row_number().over(w) - 1 + F.get(F.lit(rows_before), F.col("pid"))).alias("row"),
        (F.sum("size").over(upto) + F.get(F.lit(size_before), F.col("pid"))).alias("upto"),
    )
    return stored(placed.drop("pid"), f"{path}/running"), [size for _, size in large]


def shard_by_bytes(
    docs: DataFrame, shards: int, path: str | None = None, id_col: str = "doc_id", text: str = "text",
    overhead: int = 8, resolution: int = RESOLUTION,
) -> DataFrame:
    """id_col, size, text_crc32, shard, slot, and ``capacity``, the largest shard's bound."""
    path = path or shared_dir(docs.sparkSession, "sharding")
    rows, large = running(docs, shards, path, id_col, text, overhead)
    before = np.cumsum(large, dtype=np.int64).tolist()
    base = before[-1] if large else 0
    rest = rows.filter(F.col("own") == len(large)).groupBy("digest")
    groups = rest.agg((F.max("upto") - base).alias("end"), F.sum("size").alias("size")).select("end", "size")
    capacity, cuts = minimax_cuts(stored(groups, f"{path}/groups"), shards - len(large), resolution)
    capacity, cuts = max([capacity, *large]), [*before, *[base + c for c in cuts]]
    inner = F.lit(cuts[:-1]).cast("array<bigint>")
    shard = F.size(F.filter(inner, lambda c: c < F.col("upto"))).cast("int")
    rows = rows.withColumn("shard", shard)
    starts = [0] * shards
    for s, first in rows.groupBy("shard").agg(F.min("row")).collect():
        starts[s] = first
    slot = F.col("row") - F.get(F.lit(starts), F.col("shard"))
    return rows.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", slot.alias("slot"), F.lit(capacity).cast("long").alias("capacity"))
