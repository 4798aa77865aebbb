"""Exact duplicates through an extendible-hash index on shared files.

Rows meet by the 64-bit hash of their normalised text alone. Before the shuffle each task
merges its rows of a key to one: count, least id, least and greatest text in byte order.
A key whose least and greatest text have the same bytes has one text; the others chain.

The index holds one entry per key. Its directory starts with about as many slots as there
are full buckets and doubles while a bucket is overfull; only overfull buckets split, so
every bucket keeps its own depth. Entries find their bucket through the directory; owner
tasks take ranges of (bucket, key) and write them to shared files in order. Documents look
up the slot of their hash, there the bucket, there the entry. Where an entry chains, the
bytes of the document's text choose the link.

Only DataFrame operations are used. A text that fills a third of the table costs one row
per task in the merge. In the lookup the entries of keys with over 1 / ``HOT`` of all rows (so
fewer than ``HOT``) are copied, and their documents spread over the copies by id.

Nulls: a null text equals an empty one; null ids are ignored by the minimum (a group of
null ids keeps none of them: ``keep_id`` null, ``kept`` false). Of rows with the same id and
text all are kept, as they cannot be told apart. Other columns pass through
``dedup(...)`` untouched, whatever their names. An empty table gives no rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscape.llm.common import SPACE, free_name, shared_dir, stored, text_or_empty

CAPACITY = 4096  # entries of a bucket
BITS = 62  # of a key that the directory may use
HOT = 1000


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def key_of(text: Column, bits: int = 64) -> Column:
    """The key of a text; fewer ``bits`` make collisions, for tests."""
    return F.xxhash64(text).bitwiseAND(F.lit(-(1 << (64 - bits))))


def _slot(depth: int) -> Column:
    """The first ``depth`` bits of a key, as a number from 0."""
    top = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 64 - BITS)
    return F.shiftright(top, BITS - depth)


def directory(entries: DataFrame, path: str, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Split overfull buckets until none is left; the directory as (slot, bucket_depth,
    bucket, n) and its depth. ``bucket`` is the first slot that points to it."""
    n = entries.count()
    depth = max(0, math.ceil(math.log2(max(n, 1) / capacity)))
    level, done, part = entries.select("h"), [], 0
    while True:
        slots = stored(
            level.groupBy(_slot(depth).alias("slot"))
            .agg(F.count("*").alias("n"), (F.min("h") != F.max("h")).alias("splits")),
            f"{path}/level-{part}",
        )
        full = slots.filter((F.col("n") > capacity) & F.col("splits"))
        more = depth < BITS and not full.isEmpty()
        leaves = slots.filter(~((F.col("n") > capacity) & F.col("splits"))) if more else slots
        done.append(leaves.select("slot", F.lit(depth).alias("depth"), "n"))
        if not more:
            break
        level = level.join(full.select(F.col("slot").alias("_s")), _slot(depth) == F.col("_s"), "left_semi")
        depth, part = depth + 1, part + 1
    leaves = done[0]
    for d in done[1:]:
        leaves = leaves.union(d)
    # Each leaf answers for all slots of the doubled directory that share its first bits.
    span = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(depth) - F.col("depth"))
    first = F.col("slot") * span
    pointers = leaves.select(
        F.explode(F.sequence(first, first + span - 1)).alias("slot"), F.col("depth").alias("bucket_depth"), first.alias("bucket"), "n"
    )
    return stored(pointers, f"{path}/directory"), depth


class Index:
    """The stored index: ``pointers`` (slot, bucket), ``entries`` (bucket, h, n, keep_id,
    group_size, text_sha256, chained) and ``links`` (bucket, h, chain, t, keep_id, group_size,
    text_sha256) of the entries that chain; ``n`` counts the rows of a key."""

    def __init__(self, docs: DataFrame, path: str, id_col: str, text: str, capacity: int = CAPACITY, bits: int = 64):
        self.bits = bits
        rows = docs.select(F.col(f"`{id_col}`").alias("id"), normalised(F.col(f"`{text}`")).alias("t")).withColumn("h", key_of(F.col("t"), bits))
        merged = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("id").alias("keep_id"), F.min("t").alias("low"), F.max("t").alias("high"))
        keys = stored(
            merged.select("h", "n", "keep_id", F.sha2("low", 256).alias("text_sha256"), (F.col("low") != F.col("high")).alias("chained")),
            f"{path}/keys",
        )
        pointers, self.depth = directory(keys, path, capacity)
        self.pointers = pointers.select("slot", "bucket")
        owned = self.route(keys).repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h")
        self.entries = stored(owned, f"{path}/buckets")
        chained = self.entries.filter("chained").select("bucket", "h")
        self.chains = not chained.isEmpty()
        self.links = None
        if self.chains:
            links = self.route(rows).join(chained, ["bucket", "h"], "left_semi").groupBy("bucket", "h", "t")
            links = links.agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
            links = links.withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("t")))
            self.links = stored(links.withColumn("text_sha256", F.sha2("t", 256)), f"{path}/links")
        total = keys.agg(F.sum("n")).first()[0] or 0
        share = max(1, total // HOT)
        self.hot = self.entries.filter(F.col("n") > max(share, capacity)).select("h", F.ceil(F.col("n") / share).cast("int").alias("copies"))

    def route(self, keyed: DataFrame) -> DataFrame:
        """Rows with a key ``h``, and the bucket that the directory names for it."""
        return keyed.withColumn("slot", _slot(self.depth)).join(self.pointers, "slot").drop("slot")

    def _copied(self, entries: DataFrame) -> DataFrame:
        last = F.coalesce(F.col("copies"), F.lit(1)) - 1
        spread = entries.join(F.broadcast(self.hot), "h", "left")
        return spread.withColumn("copy", F.explode(F.sequence(F.lit(0), last))).drop("copies")

    def look_up(self, members: DataFrame, id_col: str, text: str) -> DataFrame:
        """``members`` and a struct ``exact``: keep_id, group_size, text_sha256, bucket."""
        copy = F.coalesce(F.pmod(F.xxhash64(id_col), F.col("copies")), F.lit(0)).cast("int")
        keyed = members.withColumn("h", key_of(normalised(text), self.bits)).join(F.broadcast(self.hot), "h", "left")
        routed = self.route(keyed.withColumn("copy", copy).drop("copies"))
        at = ["bucket", "h", "copy"]
        found = F.struct("keep_id", "group_size", "text_sha256", "bucket").alias("exact")
        columns = [F.col(c) for c in members.columns]
        alone = self._copied(self.entries.filter("NOT chained").withColumnRenamed("n", "group_size"))
        out = routed.join(alone, at).select(*columns, found)
        if self.chains:
            met = routed.join(self.entries.filter("chained").select("bucket", "h"), ["bucket", "h"], "left_semi")
            links = self._copied(self.links)
            out = out.union(met.withColumn("t", normalised(text)).join(links, [*at, "t"]).select(*columns, found))
        return out


def dedup(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """All columns of ``docs``, then a struct ``exact``: keep_id, group_size, kept,
    text_sha256, bucket. A column of that name keeps it; the struct then is ``exact_``."""
    index = Index(docs, path or shared_dir(docs.sparkSession, "exact-dedup"), id_col, text, capacity, bits)
    plain = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    id_at, text_at = (plain.columns[docs.columns.index(c)] for c in (id_col, text))
    out = index.look_up(plain, id_at, text_at)
    kept = F.coalesce(F.col(id_at) == F.col("exact.keep_id"), F.lit(False))
    out = out.withColumn("exact", F.col("exact").withField("kept", kept))
    return out.toDF(*docs.columns, free_name(docs, "exact"))
