"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Documents become sets of hashed 5-word shingles. Documents with equal sets form a class
and only classes are compared. The numbers of bands and rows are chosen so that a pair at
the threshold shares a band with the wanted probability. Classes meet in a shuffle on band
hashes; each band value links its members to one of them, and what hangs together by such
links is a candidate group. Every group's sets are then compared in full, all pairs of the
group at once by matrix products of set incidences, which gives exact intersections. A
large group is dealt into blocks, each pair of blocks being a unit of work of bounded
size; pairs are counted there and never become rows. What leaves a unit is, per class, how
many documents it links to and the root of its linked set.

So a group of n near copies costs about n * n / BLOCK rows between tasks and n * n
comparisons, since each link is counted.

The result has one row per document: class_id, the smallest id of the documents joined by
links (the transitive closure), n_links, how many other documents are at least as similar
as the threshold (equal ones included), and copy_of, the smallest id with an equal set.

Nulls: a null or empty text, or one without words, has no shingles, no links, and is its
own class. A text of fewer words than a shingle has one shingle of all its words. Null ids
are ignored by the minima; a class of null ids only has class_id null. Repeated rows count
as linked copies. An empty table gives no rows. Only id and text are read. Texts of any
length are read whole."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.llm.common import partitions, row_ranges, shared_dir, stored, with_struct, words

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999  # of pairs at the threshold, by banding
MOST_HASHES = 256
BLOCK = 256  # classes compared with as many others at a time
COLUMNS = 4096  # shared shingles in a matrix product
KNOWN_WORDS = 1_000_000  # hashes of words that a task remembers
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: as many rows as ``most`` hashes allow at the recall wanted, which
    keeps less similar pairs apart best."""
    best = (1, 1)
    for rows in range(1, most + 1):
        missed = 1 - threshold**rows
        bands = 1 if missed <= 0 else math.ceil(math.log(1 - recall) / math.log(missed))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """The set of shingle hashes, sorted."""
        parts = []
        for ws in words(text):
            known = self.known
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in set(ws).difference(known):
                known[w] = xxhash.xxh3_64_intdigest(w)
            parts.append(np.fromiter([known[w] for w in ws], np.uint64, len(ws)))
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(h):
            return h
        k = min(self.size, len(h))
        total = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            total = _mixed(total * MULTIPLIER + h[j : len(h) - k + 1 + j])
        return np.unique(total)


def key_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def band_hashes(shingles: np.ndarray, bands: int, rows: int, seeds: np.ndarray) -> np.ndarray:
    least = np.empty(bands * rows, np.uint64)
    for at in range(0, bands * rows, 16):  # bounded memory for very long texts
        s = seeds[at : at + 16]
        low = np.full(len(s), np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(shingles), 1 << 16):
            x = (shingles[None, a : a + (1 << 16)] ^ s[:, None]) * MULTIPLIER
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            low = np.minimum(low, x.min(1))
        least[at : at + 16] = low
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        h = _mixed(h * MULTIPLIER + least.reshape(bands, rows)[:, j])
    return h.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """id, key (of the shingle set; null without shingles) and bands of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        seeds = np.random.default_rng(11).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), 4 << 20):
                part = batch.slice(a, b - a)
                sets = [shingle(t) for t in part.column("text").to_pylist()]
                made = [band_hashes(s, bands, rows, seeds) if len(s) else None for s in sets]
                yield pa.record_batch(
                    [part.column("id"), pa.array(map(key_of, sets), pa.binary()), pa.array(made, pa.list_(pa.int64()))],
                    names=["id", "key", "bands"],
                )

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, key binary, bands array<bigint>")


def components(edges: DataFrame, path: str) -> DataFrame:
    """node, root of every node of the edges (a, b): the smallest node it hangs together
    with, by taking neighbours' roots and then roots of roots until nothing changes."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{path}/edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), f"{path}/labels-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        lower = stored(lower, f"{path}/lower-{step}")
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = stored(lower.join(up, "root").select("node", F.col("up").alias("root"), "was"), f"{path}/labels-{step}")
        if labels.filter("root <> was").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")


def compare_unit(keys: list[bytes], weights: np.ndarray, sets: list[np.ndarray], side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Documents linked to each class, linked classes, and the smallest key linked to it
    within the unit. ``side`` 0 and 1 are two blocks, of which only pairs across count; all
    0 is one block against itself."""
    n, sizes = len(keys), np.asarray([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    column, row = number[column[shared]], row[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((n, n))
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        m = np.zeros((n, COLUMNS), np.float32)
        m[row[lo:hi], column[lo:hi] - a] = 1
        common += m @ m.T  # counts up to 4096 are exact in single precision
    linked = common * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None]) - 1e-6
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None]
    rank = np.empty(n, np.int64)
    rank[sorted(range(n), key=keys.__getitem__)] = np.arange(n)
    root = rank.copy()
    near = linked | np.eye(n, dtype=bool)
    while True:
        lower = np.where(near, root[None], n).min(1)
        if (lower == root).all():
            break
        root = lower
    by_rank = sorted(keys)
    return linked @ weights, linked.sum(1), [by_rank[r] for r in root]


def verified(sets: DataFrame, threshold: float) -> DataFrame:
    """key, root, n_docs, n_classes per unit of work. ``sets``: key, weight, shingles,
    unit, side, all rows of a unit next to each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        unit, out = None, []

        def finish() -> None:
            if len(held) > 1:
                keys = [r[0] for r in held]
                docs, classes, roots = compare_unit(
                    keys, np.asarray([r[1] for r in held]), [np.frombuffer(r[2], np.uint64) for r in held], np.asarray([r[3] for r in held]), threshold
                )
                out.extend((k, r, d, c) for k, r, d, c in zip(keys, roots, docs.tolist(), classes.tolist(), strict=True) if c)
            held.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            out.clear()
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)],
                names=["key", "root", "n_docs", "n_classes"],
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("unit", "key", "weight", "shingles", "side")]
            for i in range(batch.num_rows):
                u, *r = (c[i].as_py() for c in columns)
                if u != unit:
                    finish()
                    unit = u
                held.append(tuple(r))
            yield flush()
        finish()
        yield flush()

    return sets.mapInArrow(run, "key binary, root binary, n_docs long, n_classes long")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """The columns of ``texts`` but its text, and shingles; only rows whose set has the
    given key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), 4 << 20):
                part = batch.slice(a, b - a)
                sets = [shingle(t) for t in part.column("text").to_pylist()]
                same = pa.array([key_of(s) == k for s, k in zip(sets, part.column("key").to_pylist(), strict=True)])
                made = pa.array([s.tobytes() for s in sets], pa.binary())
                yield part.drop_columns(["text"]).append_column("shingles", made).filter(same)

    fields = ", ".join(f"{n} {t}" for n, t in texts.dtypes if n != "text")
    return texts.mapInArrow(run, f"{fields}, shingles binary")


def _linked(docs: DataFrame, path: str, id_col: str, text: str, size: int, threshold: float, recall: float, block: int) -> tuple[DataFrame, DataFrame]:
    """id and key of every document; key, rep, weight, n_docs and root of every class, the
    root being the smallest key that links join it with."""
    spark = docs.sparkSession
    bands, rows = choose_bands(threshold, recall)
    signed = stored(signatures(docs, id_col, text, size, bands, rows), f"{path}/signatures")
    classes = signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    classes = stored(classes, f"{path}/classes")

    # Candidate groups: one band value links all its classes to the smallest of them.
    heads = signed.join(classes.select("key", "rep"), "key").filter(F.col("id").eqNullSafe(F.col("rep")))
    banded = stored(heads.select("key", F.explode("bands").alias("band")), f"{path}/bands")
    centres = banded.groupBy("band").agg(F.min("key").alias("a"), F.max("key").alias("z")).filter("a <> z").select("band", "a")
    edges = banded.join(centres, "band").filter("key <> a").select("a", F.col("key").alias("b")).distinct()
    groups = components(edges, f"{path}/candidates").select(F.col("node").alias("key"), F.col("root").alias("group"))
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    candidates = stored(groups.join(sizes, "group").join(classes, "key"), f"{path}/groups")

    # Their texts, as sets, to the units of work.
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # A merge join at any size: how many candidates there are follows the data, not a bound.
    found = source.join(candidates.hint("merge"), F.col("id").eqNullSafe(F.col("rep"))).drop("id", "rep")
    sets = shingle_sets(found, size).dropDuplicates(["key"])
    mine = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = sets.withColumn("mine", mine).withColumn("other", other)
    unit = F.xxhash64("group", F.least("mine", "other"), F.greatest("mine", "other"))
    dealt = dealt.select("key", "weight", "shingles", unit.alias("unit"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
    units = dealt.repartition(partitions(spark), "unit").sortWithinPartitions("unit")
    links = stored(verified(units, threshold), f"{path}/links")

    # Classes joined by links, then documents.
    roots = components(links.filter("key <> root").select(F.col("root").alias("a"), F.col("key").alias("b")), f"{path}/joined")
    counts = links.groupBy("key").agg(F.sum("n_docs").alias("n_docs"))
    per_class = classes.join(counts, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    return signed.select("id", "key"), stored(per_class.withColumn("root", F.coalesce("root", "key")), f"{path}/linked")


def jaccard_join(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE,
    threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """id_col, class_id, n_links, copy_of for every document."""
    path = path or shared_dir(docs.sparkSession, "jaccard")
    signed, per_class = _linked(docs, path, id_col, text, size, threshold, recall, block)
    first = per_class.groupBy("root").agg(F.min("rep").alias("class_id"))
    per_class = per_class.join(first, "root").select(
        "key", "class_id", (F.col("weight") - 1 + F.coalesce("n_docs", F.lit(0))).alias("n_links"), F.col("rep").alias("copy_of")
    )
    joined = signed.filter("key IS NOT NULL").join(per_class, "key").select("id", "class_id", "n_links", "copy_of")
    alone = signed.filter("key IS NULL").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("copy_of"))
    return joined.union(alone).withColumnRenamed("id", id_col)


def keep_one(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE,
    threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id, and of rows that
    share it the smallest key of their shingle sets (of equal sets, any one). Documents
    without words, and those with null ids, all stay."""
    path = path or shared_dir(docs.sparkSession, "jaccard")
    signed, per_class = _linked(docs, path, id_col, text, size, threshold, recall, block)
    first = per_class.filter("rep IS NOT NULL").groupBy("root").agg(F.min(F.struct("rep", "key")).alias("first"))
    heads = stored(first.select(F.col("first.rep").alias("head"), F.col("first.key").alias("key")), f"{path}/heads")

    # An id may be in several rows, of several classes; only those rows' sets are made again.
    marked = signed.join(heads, "key", "left").select("id", (F.col("key").isNull() | F.coalesce(F.col("id") == F.col("head"), F.lit(False))).alias("stays"))
    ids = marked.filter("id IS NOT NULL").groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("_n"), F.max("stays").alias("_stays"))
    names = [f"_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at, text_at = (names[docs.columns.index(c)] for c in (id_col, text))
    kept = plain.join(ids.filter("_stays"), F.col(at) == F.col("_id"))
    once = kept.filter("_n = 1").select(names)
    if not ids.filter("_stays AND _n > 1").isEmpty():
        keyed = with_struct(kept.filter("_n > 1").select(names), text_at, "_set", "key: binary", lambda texts: [(key_of(s),) for s in map(Shingler(size), texts)])
        once = once.union(keyed.filter("_set.key IS NULL").select(names))
        keyed = keyed.filter("_set.key IS NOT NULL").withColumn("_key", F.col("_set.key"))
        held = keyed.join(heads.withColumnRenamed("key", "_key"), "_key").filter(F.col(at) == F.col("head"))
        once = once.union(held.dropDuplicates(["_key"]).select(names))
    return once.union(plain.filter(F.col(at).isNull())).toDF(*docs.columns)
