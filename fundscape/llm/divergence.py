"""Source divergence audit: which sources of a language differ, and by which terms.

Terms are runs of ASCII letters and of code points from U+0080 on, A-Z lower-cased. A language
keeps its V terms that are in at least ``least`` of its documents. In a group (a language, or a source in it)
of N kept occurrences a term seen ``count`` times has p = 1 + floor(10^9 (count + 2) / (N + 2V)).
Two groups differ in a term by f = floor((p - q)^2 / (p + q)), in exact integers.

Part ``pair`` sums f over all kept terms for every two sources of a language. Absent terms
all have the same p, so the sum is taken as V terms absent from both, corrected by the counts of each
source alone (a histogram: one row per distinct count) and by the terms that both have. The
latter are summed up by tasks that hold all rows of a term, with no row per pair and term.

Part ``term`` gives the ``best`` terms of a source against its language, of those with p > q, by dominance skyband. A term that
another one beats in group count (not less), language count (not more) and UTF-8 order (before) ranks
behind it, as f grows with p and falls with q. So each partition keeps the terms with fewer than
``best`` such others; what tasks kept is merged, first by salted parts of a group, then by group,
and only the merged skyband is ranked by exact f.

Nulls: null text, lang and source count as ''. A group without terms has pairs, with value 0 where V
is 0. Texts without terms and empty ones add nothing but their group. Repeated rows are documents of
their own. An empty table gives no rows. Ties go by UTF-8 order. Only the three columns are read,
other columns stay out. Texts of any length are read whole, some megabytes at a time."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscape.llm.common import PIECE, partitions, row_ranges, shared_dir, stored

LEAST = 10
BEST = 10
HELD = 1_000_000  # terms that a task counts before it hands them on
BUFFER = 4096  # rows of a group between two sifts of its skyband
MOST_ROWS = 500_000  # rows that a task holds in skybands before it hands them on

# Lower-cases A-Z and turns every byte outside terms into a space.
TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    data, at = text.translate(TERMS), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """lang, source, term, count, docs; several rows per term, as tasks hand them on."""
    names = ["lang", "source", "term", "count", "docs"]

    def flush(counts: dict) -> Iterator[pa.RecordBatch]:
        for (l, s), (n, d) in counts.items():
            for at in range(0, len(n), 1 << 16):
                some = list(n)[at : at + (1 << 16)] if len(n) > 1 << 16 else list(n)
                columns = [
                    pa.array([l] * len(some), pa.string()), pa.array([s] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array([n[t] for t in some], pa.int64()), pa.array([d[t] for t in some], pa.int64()),
                ]
                yield pa.record_batch(columns, names=names)
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            for a, b in row_ranges(batch.column("text"), 4 << 20):
                part = batch.slice(a, b - a)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for l, s, t in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts, strict=True):
                    if (l, s) not in counts:
                        counts[l, s] = Counter(), Counter()
                    n, d = counts[l, s]
                    seen: set[bytes] = set()
                    for some in pieces(t):
                        n.update(some)
                        seen.update(some)
                    d.update(seen)
                if sum(len(n) for n, _ in counts.values()) > HELD:
                    yield from flush(counts)
        yield from flush(counts)

    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    return docs.select(*columns).mapInArrow(run, "lang string, source string, term string, count long, docs long")


def kept_terms(counted: DataFrame, least: int) -> DataFrame:
    """lang, source, term, count, total (in the language), head (true in one row per term) of
    the kept terms; one shuffle, by language and term."""
    rows = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    rows = rows.select(
        "lang", "source", "term", "count", F.sum("count").over(term).alias("total"), F.sum("docs").over(term).alias("docs"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("head"),
    )
    return rows.filter(F.col("docs") >= least).drop("docs")


def share(count: str, n: str) -> Column:
    """p, exact beyond 64 bits; null where the language keeps no term."""
    return F.expr(f"CASE WHEN v > 0 THEN 1 + (CAST({count} + 2 AS DECIMAL(20, 0)) * 1000000000) div CAST({n} + 2 * v AS DECIMAL(20, 0)) END")


def gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def shared_terms(rows: DataFrame) -> DataFrame:
    """lang, a, b, value per task: what the terms that both sources have add to the sum over
    terms taken as absent from one of them. ``rows``: lang, term, source, p, p0, those of a
    term next to each other."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["lang", "a", "b"]).aggregate([("value", "sum")]).rename_columns(["lang", "a", "b", "value"])

    def pairs(t: pa.Table) -> list[pa.Table]:
        codes = [t.column(c).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in ("lang", "term")]
        term = np.r_[0, np.cumsum((np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0))]
        p, p0 = (t.column(c).to_numpy() for c in ("p", "p0"))
        out = []
        for d in range(1, int(np.bincount(term).max())):
            i = np.flatnonzero(term[:-d] == term[d:])
            j = i + d
            value = f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
            part = pa.table({"lang": t.column("lang").take(i), "a": t.column("source").take(i), "b": t.column("source").take(j), "value": value})
            out.append(summed([part]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
        held, sums = None, []
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            last = len(t) - 1
            key = (t.column("lang")[last], t.column("term")[last])
            while last and (t.column("lang")[last - 1], t.column("term")[last - 1]) == key:
                last -= 1
            held = t.slice(last)  # this term may go on in the next batch
            if last:
                sums += pairs(t.slice(0, last))
            if sums:
                sums = [summed(sums)]
                if len(sums[0]) > HELD:
                    yield from sums[0].cast(schema).to_batches(1 << 16)
                    sums = []
        if held is not None:
            sums += pairs(held)
        if sums:
            yield from summed(sums).cast(schema).to_batches(1 << 16)

    return rows.select("lang", "term", "source", "p", "p0").mapInArrow(run, "lang string, a string, b string, value long")


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language, either way."""
    p0 = groups.withColumn("p0", share("0", "n"))
    rows = kept.join(p0, ["lang", "source"]).withColumn("p", share("count", "n"))
    together = rows.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = shared_terms(together)

    other = p0.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    counts = rows.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
    alone = counts.join(other, "lang").filter("source <> item").select(
        "lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b"),
        F.expr(f"terms * ({gap('p', 'q0')} - {gap('p0', 'q0')})").alias("value"),
    )
    absent = p0.join(other, "lang").filter("source < item").select(
        "lang", F.col("source").alias("a"), F.col("item").alias("b"), F.expr(f"CASE WHEN v > 0 THEN v * ({gap('p0', 'q0')}) ELSE 0 END").alias("value")
    )
    sums = absent.union(alone).union(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return sums.select("lang", "value", F.expr("inline(array(struct(a AS source, b AS item), struct(b AS source, a AS item)))")).select("lang", "source", "item", "value")


class Skyband:
    """Rows (count, total, term) of one group that fewer than ``k`` others dominate."""

    def __init__(self, k: int):
        self.k = k
        self.count, self.total, self.term = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        self.fresh: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []
        self.waiting = 0

    def add(self, count: np.ndarray, total: np.ndarray, term: list[bytes]) -> None:
        self.fresh.append((count, total, term))
        self.waiting += len(term)

    def sift(self) -> None:
        """Take the waiting rows in. Others that dominate a row come before it in the order by count,
        total and term, and k of them are kept if there are k, so kept rows suffice."""
        if not self.fresh:
            return
        count, total = (np.concatenate([x, *[r[i] for r in self.fresh]]) for i, x in enumerate((self.count, self.total)))
        term = [*self.term, *[t for r in self.fresh for t in r[2]]]
        old, self.fresh, self.waiting = len(self.term), [], 0
        rank = np.empty(len(term), np.int64)
        rank[sorted(range(len(term)), key=term.__getitem__)] = np.arange(len(term))
        open_ = np.ones(len(term), bool)
        for a in range(old, len(term) if old else old, 1024):
            s = slice(a, a + 1024)
            beaten = (count[None, :old] >= count[s, None]) & (total[None, :old] <= total[s, None]) & (rank[None, :old] < rank[s, None])
            open_[s] = beaten.sum(1) < self.k
        order = np.lexsort((rank, total, -count))
        order = order[open_[order]]
        c, t, r = count[order], total[order], rank[order]
        stays = np.zeros(len(order), bool)
        kt, kr, n = np.empty(len(order), np.int64), np.empty(len(order), np.int64), 0
        for i in range(len(order)):  # counts of those kept are not less
            if n < self.k or np.count_nonzero((kt[:n] <= t[i]) & (kr[:n] < r[i])) < self.k:
                kt[n], kr[n], stays[i] = t[i], r[i], True
                n += 1
        order = order[stays]
        self.count, self.total, self.term = count[order], total[order], [term[i] for i in order]


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The rows (lang, source, term, count, total) that fewer than ``k`` others of their group in the
    same task dominate."""

    def flush(bands: dict) -> Iterator[pa.RecordBatch]:
        for (l, s), band in bands.items():
            band.sift()
            n = len(band.term)
            columns = [pa.array([l] * n, pa.string()), pa.array([s] * n, pa.string()), pa.array(band.term, pa.binary()).cast(pa.string()), pa.array(band.count), pa.array(band.total)]
            yield pa.record_batch(columns, names=["lang", "source", "term", "count", "total"])
        bands.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands: dict[tuple, Skyband] = {}
        held = 0
        for batch in batches:
            term = batch.column("term").cast(pa.binary())
            count, total = (batch.column(c).to_numpy() for c in ("count", "total"))
            group = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["l", "s"])
            code = np.zeros(batch.num_rows, np.int64)
            for c in ("lang", "source"):
                d = batch.column(c).dictionary_encode()
                code = code * (len(d.dictionary) + 1) + d.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(code[order])) + 1) if len(order) else []:
                g = group[int(at[0])].as_py()
                band = bands.setdefault((g["l"], g["s"]), Skyband(k))
                band.add(count[at], total[at], term.take(pa.array(at)).to_pylist())
                if band.waiting > BUFFER:
                    band.sift()
            held += batch.num_rows
            if held > MOST_ROWS:
                for band in bands.values():
                    band.sift()
                held = sum(len(b.term) for b in bands.values())
                if held > MOST_ROWS // 2:
                    yield from flush(bands)
                    held = 0
        yield from flush(bands)

    return rows.select("lang", "source", "term", "count", "total").mapInArrow(run, "lang string, source string, term string, count long, total long")


def term_part(kept: DataFrame, groups: DataFrame, langs: DataFrame, best: int) -> DataFrame:
    """lang, source, item, value of the terms that may be among the ``best`` of their group."""
    parts = max(2, math.isqrt(partitions(kept.sparkSession)))
    local = skybands(kept, best).withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(parts)))
    merged = skybands(skybands(local.repartition("lang", "source", "salt"), best).repartition("lang", "source"), best)
    rows = merged.join(groups, ["lang", "source"]).join(langs.select("lang", F.col("n").alias("ln")), "lang")
    valued = rows.withColumn("p", share("count", "n")).withColumn("q", share("total", "ln")).filter("p > q")
    return valued.select("lang", "source", F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))


def audit(
    docs: DataFrame, path: str | None = None, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST, best: int = BEST
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    path = path or shared_dir(docs.sparkSession, "divergence")
    kept = stored(kept_terms(term_counts(docs, lang, source, text), least), f"{path}/terms")
    langs = stored(kept.groupBy("lang").agg(F.sum("count").alias("n"), F.count(F.when(F.col("head"), 1)).alias("v")), f"{path}/languages")
    sizes = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))])
    groups = named.distinct().join(sizes, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang", "left")
    groups = stored(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")), f"{path}/groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = [
        part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most if most else F.lit(True))
        .select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
        for name, part, most in (("pair", pair_part(kept, groups), None), ("term", term_part(kept, groups, langs, best), best))
    ]
    return out[0].union(out[1])
