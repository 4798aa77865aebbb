"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a document's set holds its distinct 2-word
shingles, or its whole word sequence if it has fewer words. Documents are linked at Jaccard
similarity 0.8 or more, found by integers: 100 * common >= 80 * union.

*Signatures.* Each shingle seeds a random permutation of the signature's slots, made swap by swap.
In step j all shingles of a document draw for the slot that their permutation has in place j;
a slot takes the smallest ``j + draw``. The steps are correlated ranks: a slot filled in step j can't
be lowered by a later step, so a document stops once all its slots are filled (a few steps for
usual texts, in place of one pass per slot). Two sets agree in a slot with probability equal
to their similarity, with lower variance than independent hashes.

*Candidates.* Documents with equal sets are one class and only classes are compared. Slots
form bands; classes with an equal band value are a bucket. Bands and rows are chosen so that a
pair at the threshold shares a bucket with the wanted probability (0.9999).

*Verification*, on whole sets, until no bucket has two classes that are neither joined nor compared:
each class against the smallest key it meets in any bucket; then against the smallest key of each
of its buckets, where not joined yet; then, in buckets that still hold several groups, all
classes of different groups, in blocks of bounded size by matrix products. Classes of one group are not compared
with each other, so n near copies cost about n comparisons, not n * n.

*Union-find.* Links found by a task are joined there by union-find with path halving; what is left,
one row per class and task, is joined across tasks by pointer doubling over tables.

Nulls: null and empty texts, and those without words, have n_shingles 0 and are alone in their
component. A null id never becomes a component id unless all ids of the component are null, then
component_id is null and kept true. Repeated rows are copies: all are linked, rows that share
the smallest id are all kept. An empty table gives no rows. Only id and text are read; other
columns stay out. Texts of any length are read whole."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.llm.common import PIECE, partitions, row_ranges, shared_dir, stored
from fundscape.llm.jaccard_join import choose_bands, components

SHINGLE = 2
PERCENT = 80
RECALL = 0.9999  # of pairs at the threshold, by banding
SLOTS = 256  # most slots; a slot number is a byte
AT_ONCE = 1 << 15  # shingles that take their steps together
KNOWN_WORDS = 1_000_000  # hashes of words that a task remembers
BLOCK = 256  # classes, and
BLOCK_SHINGLES = 1 << 20  # shingles, of a block
COLUMNS = 4096  # shared shingles in a matrix product
HELD = 1_000_000  # classes that a task joins before it hands them on

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)
# Lower-cases A-Z and turns the white space of the contract into spaces.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
SPACES = re.compile(rb" +")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """The sorted shingle hashes of texts."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        data, at, parts = (text or "").encode().translate(TABLE), 0, []
        while at < len(data):
            end = data.find(b" ", at + PIECE)
            end = len(data) if end < 0 else end
            words, at = [w for w in data[at:end].split(b" ") if w], end
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            for w in set(words).difference(self.known):
                self.known[w] = xxhash.xxh3_64_intdigest(w)
            parts.append(np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words)))
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(h):
            return h
        k = min(self.size, len(h))
        total = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            total = mixed(total * GOLDEN + h[j : len(h) - k + 1 + j])
        return np.unique(total)


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values per set (none of them empty). A value holds the step in its upper
    and the draw in its lower 32 bits."""
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    flat, steps = out.reshape(-1), np.arange(1, slots + 1, dtype=np.uint64) * GOLDEN
    sizes = np.asarray([len(s) for s in sets])
    first = 0
    while first < len(sets):
        last = first + 1 + int(np.searchsorted(np.cumsum(sizes[first + 1 :]), AT_ONCE - sizes[first], "right"))
        shingles, owner = np.concatenate(sets[first:last]), np.repeat(np.arange(first, last), sizes[first:last])
        for a in range(0, len(shingles), AT_ONCE):  # a long set in several parts
            x, own = shingles[a : a + AT_ONCE], owner[a : a + AT_ONCE]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(x), 1))
            row = np.arange(len(x))
            for j in range(slots):
                drawn = mixed(x + steps[j])
                k = j + (((drawn >> HALF) * np.uint64(slots - j)) >> HALF).astype(np.int64)
                slot = order[row, k]
                order[row, k] = order[row, j]
                value = (np.uint64(j) << HALF) | (drawn & LOW)
                np.minimum.at(flat, own * slots + slot, value)
                filled = np.zeros(len(sets), bool)
                here = np.unique(own)
                filled[here] = out[here].max(1) < np.uint64(j + 1) << HALF
                if filled[here].all():
                    break
                if filled[here].any():
                    go = ~filled[own]
                    x, own, order, row = x[go], own[go], order[go], np.arange(int(go.sum()))
        first = last
    return out


def band_values(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of each row of signatures."""
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for j in range(rows):
        h = mixed(h * GOLDEN + parts[:, :, j])
    return h.view(np.int64)


def key_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """id, n (shingles), key (of the set; null if empty) and bands of each row of ``docs`` (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), 4 << 20):
                part = batch.slice(a, b - a)
                sets = [shingle(t) for t in part.column("text").to_pylist()]
                full = [s for s in sets if len(s)]
                made = iter(band_values(superminhash(full, bands * rows), bands, rows) if full else ())
                columns = [
                    part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(key_of, sets), pa.binary()),
                    pa.array([next(made) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.record_batch(columns, names=["id", "n", "key", "bands"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n long, key binary, bands array<bigint>")


def candidate_sets(found: DataFrame, size: int) -> DataFrame:
    """key, n, shingles of the rows (key, text) whose text has that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), 4 << 20):
                part = batch.slice(a, b - a)
                sets = [(k, s) for k, t in zip(part.column("key").to_pylist(), part.column("text").to_pylist(), strict=True) if key_of(s := shingle(t)) == k]
                columns = [pa.array([k for k, _ in sets], pa.binary()), pa.array([len(s) for _, s in sets], pa.int64()), pa.array([s.tobytes() for _, s in sets], pa.binary())]
                yield pa.record_batch(columns, names=["key", "n", "shingles"])

    return found.mapInArrow(run, "key binary, n long, shingles binary")


def are_linked(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """Whether sets of ``a`` and ``b`` shingles with ``common`` ones are linked; whole numbers only."""
    return (100 + percent) * common >= percent * (a + b)


class Forest:
    """Union-find over keys; every root is the smallest of its tree."""

    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def find(self, x: bytes) -> bytes:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p]
        return x

    def join(self, a: bytes, b: bytes) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def links(self) -> pa.RecordBatch:
        pairs = [(r, x) for x in list(self.up) if (r := self.find(x)) != x]
        self.up.clear()
        return pa.record_batch([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], names=["a", "b"])


def linked_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """a, b: links of trees over the verified rows (a, b, sa, sb with the sets) of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b, sa, sb in zip(*[batch.column(c) for c in ("a", "b", "sa", "sb")], strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                if are_linked(len(np.intersect1d(x, y, True)), len(x), len(y), percent):
                    forest.join(a.as_py(), b.as_py())
            if len(forest.up) > HELD:
                yield forest.links()
        yield forest.links()

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def common_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of every two sets."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    number = np.cumsum(times > 1) - 1
    column, row = number[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((n, n), np.int64)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        m = np.zeros((n, COLUMNS), np.float32)
        m[row[lo:hi], column[lo:hi] - a] = 1
        common += (m @ m.T).astype(np.int64)  # up to 4096, exact in single precision
    return common


def linked_units(units: DataFrame, percent: int) -> DataFrame:
    """a, b: links of trees over the classes (unit, key, root, shingles) of each unit, whose rows
    stand next to each other; only classes of different roots are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, unit, held = Forest(), None, []

        def finish() -> None:
            if len({r for _, r, _ in held}) > 1:
                sets = [np.frombuffer(s, np.uint64) for _, _, s in held]
                sizes = np.asarray([len(s) for s in sets])
                _, root = np.unique(np.asarray([r for _, r, _ in held], object), return_inverse=True)
                linked = are_linked(common_shingles(sets), sizes[:, None], sizes[None], percent) & (root[:, None] != root[None])
                for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
                    forest.join(held[i][0], held[j][0])
            held.clear()

        for batch in batches:
            for u, k, r, s in zip(*[batch.column(c) for c in ("unit", "key", "root", "shingles")], strict=True):
                if u.as_py() != unit:
                    finish()
                    unit = u.as_py()
                held.append((k.as_py(), r.as_py(), s.as_py()))
            if len(forest.up) > HELD:
                yield forest.links()
        finish()
        yield forest.links()

    return units.select("unit", "key", "root", "shingles").mapInArrow(run, "a binary, b binary")


def tested(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the pairs (a, b), with both sets fetched by key."""
    a = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"), F.col("n").alias("na"))
    b = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"), F.col("n").alias("nb"))
    joined = pairs.join(b, "b").join(a.hint("merge"), "a")
    return linked_pairs(joined.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)"), percent)


def units_of(members: DataFrame, sets: DataFrame, path: str, block: int) -> DataFrame:
    """Rows (unit, key, root, shingles): the classes of buckets with several groups, dealt so that
    any two of different groups meet in a unit. ``members``: band, key, n, root.

    A bucket's largest group has blocks of its own, which are not compared with each other; all
    other classes share blocks, and each of these meets every block."""
    groups = members.groupBy("band", "root").agg(
        F.count("*").alias("classes"), F.sum("n").alias("shingles"), *[F.bit_xor(F.xxhash64(F.lit(i), "key", "root")).alias(f"x{i}") for i in (0, 1)]
    )
    need = [F.ceil(F.greatest(F.col(f"{c}.classes") / block, F.col(f"{c}.shingles") / BLOCK_SHINGLES)).cast("int") for c in ("rest", "top")]
    buckets = groups.groupBy("band").agg(
        F.max(F.struct("classes", "shingles", "root")).alias("top"), F.count("*").alias("groups"), F.sum("classes").alias("classes"), F.sum("shingles").alias("shingles"),
        F.bit_xor("x0").alias("x0"), F.bit_xor("x1").alias("x1"),
    ).filter("groups > 1 AND classes > 2")
    # Several bands may have a bucket of the same classes.
    buckets = buckets.groupBy("classes", "shingles", "x0", "x1").agg(F.min("band").alias("band"), F.first("top").alias("top"))
    rest = F.struct((F.col("classes") - F.col("top.classes")).alias("classes"), (F.col("shingles") - F.col("top.shingles")).alias("shingles"))
    buckets = buckets.withColumn("rest", rest).select("band", F.col("top.root").alias("largest"), need[0].alias("shared"), need[1].alias("own"))
    dealt = members.join(stored(buckets, f"{path}/buckets"), "band").withColumn("apart", F.col("root") == F.col("largest"))
    place = F.expr("CASE WHEN apart THEN shared + pmod(xxhash64(key), own) ELSE pmod(xxhash64(key), shared) END")
    other = F.expr("explode(sequence(0, CASE WHEN apart THEN shared ELSE shared + own END - 1))")
    dealt = dealt.withColumn("place", place).withColumn("other", other)
    unit = F.xxhash64("band", F.least("place", "other"), F.greatest("place", "other"))
    rows = dealt.select("key", "root", unit.alias("unit")).join(sets.select("key", "shingles").hint("merge"), "key")
    return rows.repartition(partitions(members.sparkSession), "unit").sortWithinPartitions("unit")


def joined(links: DataFrame, path: str) -> DataFrame:
    """key and root of every class that links join with another."""
    return components(links, path).select(F.col("node").alias("key"), "root")


def with_roots(df: DataFrame, roots: DataFrame, key: str, name: str) -> DataFrame:
    found = roots.select(F.col("key").alias(key), F.col("root").alias(name))
    return df.join(found, key, "left").withColumn(name, F.coalesce(name, key))


def class_links(members: DataFrame, sets: DataFrame, path: str, percent: int, block: int) -> DataFrame:
    """a, b: trees that join what links join. ``members``: band, key, n, centre (the smallest key) of buckets."""
    arms = members.filter("key <> centre").select(F.col("centre").alias("a"), F.col("key").alias("b"))
    first = stored(arms.groupBy("b").agg(F.min("a").alias("a")), f"{path}/first")
    links = stored(tested(first, sets, percent), f"{path}/links-1")
    roots = joined(links, f"{path}/joined-1")

    rest = arms.distinct().join(first, ["a", "b"], "left_anti")
    apart = with_roots(with_roots(rest, roots, "a", "ra"), roots, "b", "rb").filter("ra <> rb").select("a", "b")
    links = stored(links.union(tested(apart, sets, percent)), f"{path}/links-2")
    roots = joined(links, f"{path}/joined-2")

    units = units_of(stored(with_roots(members.select("band", "key", "n"), roots, "key", "root"), f"{path}/rooted"), sets, path, block)
    return stored(links.union(linked_units(units, percent)), f"{path}/links-3")


def near_groups(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE,
    percent: int = PERCENT, recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """id_col, n_shingles, component_id, kept for every document."""
    path = path or shared_dir(docs.sparkSession, "superminhash")
    bands, rows = choose_bands(percent / 100, recall, SLOTS)
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = stored(signatures(plain, size, bands, rows), f"{path}/signatures")
    classes = signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes, f"{path}/classes")

    banded = stored(classes.select("key", "n", F.explode("bands").alias("band")), f"{path}/bands")
    centres = banded.groupBy("band").agg(F.min("key").alias("centre"), F.max("key").alias("last")).filter("centre <> last").drop("last")
    members = stored(banded.join(stored(centres, f"{path}/centres"), "band"), f"{path}/members")

    # The candidates' sets. A merge join at any size: how many there are follows the data.
    wanted = stored(members.select("key").distinct().join(classes.select("key", "rep"), "key"), f"{path}/wanted")
    found = plain.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("rep"))).select("key", "text")
    sets = stored(candidate_sets(found, size).dropDuplicates(["key"]), f"{path}/sets")

    roots = joined(class_links(members, sets, path, percent, block), f"{path}/joined-3")
    linked = stored(roots.join(classes.select("key", "rep"), "key"), f"{path}/linked")
    least = stored(linked.groupBy("root").agg(F.min("rep").alias("component_id")), f"{path}/least")
    component = linked.join(least, "root").select("key", "component_id", F.lit(True).alias("_linked"))
    resolved = classes.select("key", "rep").join(component, "key", "left").select("key", F.when(F.col("_linked"), F.col("component_id")).otherwise(F.col("rep")).alias("component_id"))
    resolved = stored(resolved, f"{path}/resolved")
    out = signed.filter("key IS NOT NULL").join(resolved, "key").select("id", "n", "component_id")
    out = out.union(signed.filter("key IS NULL").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
