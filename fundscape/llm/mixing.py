"""Mix sources to token targets by entropy balancing.

Find document rates that stay as close as can be to 1, in relative entropy per token, and
meet one token constraint per source. The solution tilts every document exponentially,
rate = exp(lambda of its source), and lambda solves a convex dual: the sum over sources of
tokens * exp(lambda) - target * lambda is least where tokens * exp(lambda) = target. Newton
iterations run on tables: each computes every source's gradient and curvature with one
aggregation and steps, halving the step where it would overshoot.

Rates become copies: every document gets the whole part, and one more goes to documents
in the order of a hash of id and text while the source's remaining tokens last. The place
where they run out is found by narrowing hash ranges, one histogram per source and round,
never by sorting a source; what is left is filled by later documents small enough for it, in
``PASSES`` passes. The first pass stops at a document that is larger than what its source still
lacks, so a source misses its target by less than its longest document.

Nulls: a null source is a source of its own, last in order; a null text has size 0; a null
id hashes as such. Repeated rows (of a source, id and text) are numbered, in any order, and each
number hashes on its own, so that copies are taken one by one; how many are taken depends on nothing
but the table. A source without tokens has target 0. An empty table gives no rows.
Only the columns named are read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscape.llm.common import partitions, shared_dir, stored

TOLERANCE = 1e-12
STEPS = 60  # of Newton; a target at three times the source needs about 7
HASH_BITS, ROUND_BITS, ROUNDS = 60, 12, 3
PASSES = 4
SMALL_TABLE = 100_000  # sources that may be broadcast


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def running(df: DataFrame, order: list[Column], sums: list[str], path: str) -> tuple[DataFrame, dict[str, float]]:
    """``df`` with ``row`` (from 0) and for each of ``sums`` its total before the row, in an ``order`` that
    tells rows apart, and the totals of all rows. Rows are sorted over range partitions; the driver sees
    one line per partition."""
    ranges = stored(df.repartitionByRange(partitions(df.sparkSession), *order).withColumn("pid", F.spark_partition_id()), path)
    found = sorted(ranges.groupBy("pid").agg(F.count("*"), *[F.sum(c) for c in sums]).collect())
    before = [[0] * (found[-1][0] + 1 if found else 1) for _ in range(len(sums) + 1)]
    total = [0] * (len(sums) + 1)
    for pid, *values in found:
        for i, v in enumerate(values):
            before[i][pid] = total[i]
            total[i] += v
    w = Window.partitionBy("pid").orderBy(*order)
    above = w.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("row", F.row_number().over(w) - 1 + F.get(F.lit(before[0]), F.col("pid")))
    for c, b in zip(sums, before[1:], strict=True):
        placed = placed.withColumn(f"{c}_before", F.coalesce(F.sum(c).over(above), F.lit(0)) + F.get(F.lit(b), F.col("pid")))
    return placed.drop("pid"), dict(zip(sums, total[1:], strict=True))


def source_targets(sizes: DataFrame, most: float, path: str) -> DataFrame:
    """source, source_size, target: sources weigh 1, 2, 3, repeating, by code point (null
    last) and share all tokens by weight, at most ``most`` times their own; what exceeds
    that is shared again by weight.

    In the order of limit / weight the sources held at their limit come first, so the
    level of the rest follows from running sums."""
    source = F.col("source").asc_nulls_last()
    per, _ = running(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), [source], [], f"{path}/by-source")
    per = per.withColumn("weight", F.col("row") % 3 + 1).withColumn("limit", most * F.col("source_size")).drop("row")
    per, total = running(per, [F.col("limit") / F.col("weight"), source], ["source_size", "limit", "weight"], f"{path}/by-limit")
    left = (F.lit(total["source_size"]) - F.col("limit_before")) / (F.lit(total["weight"]) - F.col("weight_before"))
    per = stored(per.withColumn("left", left), f"{path}/levels")
    level = per.filter(F.col("limit") >= F.col("left") * F.col("weight")).agg(F.min_by("left", "row")).scalar()
    target = F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit")))
    return per.select("source", "source_size", target.alias("target"))


def balance(targets: DataFrame, path: str) -> DataFrame:
    """source, source_size, target, tilt (lambda): the dual solution by Newton iterations.
    A source without tokens or target has a tilt of minus infinity, so rate 0."""
    live = (F.col("source_size") > 0) & (F.col("target") > 0)
    now = F.col("source_size") * F.exp("tilt")
    state = stored(targets.withColumn("tilt", F.when(live, 0.0).otherwise(F.lit(-math.inf))), f"{path}/newton-0")
    for step in range(1, STEPS + 1):
        gradient, curvature = now - F.col("target"), now
        move = F.greatest(F.least(-gradient / curvature, F.lit(1.0)), F.lit(-1.0))
        state = stored(state.withColumn("tilt", F.when(live, F.col("tilt") + move).otherwise(F.col("tilt"))), f"{path}/newton-{step}")
        off = state.filter(live).agg(F.max(F.abs(now / F.col("target") - 1))).first()[0]
        if off is None or off <= TOLERANCE:
            break
    return state


def with_source(df: DataFrame, per_source: DataFrame, n_sources: int, *columns: str) -> DataFrame:
    side = per_source.select(F.col("source").alias("_s"), *columns)
    if n_sources <= SMALL_TABLE:
        side = F.broadcast(side)
    return df.join(side, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def hash_limits(sizes: DataFrame, need: DataFrame, n_sources: int, path: str) -> DataFrame:
    """source, limit, used: take documents with u < limit, ``used`` tokens in all, as many
    as fit into ``need``. ``sizes`` holds the documents to choose from.

    Each round cuts the range of u in which a source overflows into 4096 bins and goes on
    in the first bin that does not fit whole. A source that never overflows takes all."""
    zero = F.lit(0).cast("long")
    state = need.select("source", "need", zero.alias("limit"), zero.alias("used"), F.lit(False).alias("all"))
    w = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    for r in range(ROUNDS):
        shift = HASH_BITS - ROUND_BITS * (r + 1)
        at = with_source(sizes, state.filter(~F.col("all")), n_sources, "limit")
        if r:
            at = at.filter(F.shiftright("u", shift + ROUND_BITS) == F.shiftright("limit", shift + ROUND_BITS))
        bins = at.groupBy("source", F.shiftright("u", shift).alias("bin")).agg(F.sum("size").alias("bin_size"))
        bins = with_source(bins.withColumn("upto", F.sum("bin_size").over(w)), state, n_sources, "need", "used")
        fits = F.col("used") + F.col("upto") <= F.col("need")
        first = bins.groupBy("source").agg(
            F.min(F.when(~fits, F.col("bin"))).alias("bin"), F.coalesce(F.max(F.when(fits, F.col("upto"))), zero).alias("below")
        )
        first = first.withColumnRenamed("source", "_s")
        joined = state.join(first, F.col("source").eqNullSafe(F.col("_s")), "left")
        state = joined.select(
            "source",
            "need",
            F.coalesce(F.shiftleft("bin", shift), F.col("limit") if r else F.lit(1 << HASH_BITS)).alias("limit"),
            (F.col("used") + F.coalesce("below", zero)).alias("used"),
            (F.col("bin").isNull() if r == 0 else F.col("all")).alias("all"),
        )
        state = stored(state, f"{path}-{r}")
    return state.select("source", "limit", "used")


def mix(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", source: str = "source",
    most: int = 3,
) -> DataFrame:
    """id_col, source, size, source_size, target, rate and copies of every row."""
    path = path or shared_dir(docs.sparkSession, "mixing")
    t, i = F.col(f"`{text}`"), F.col(f"`{id_col}`")
    sizes = stored(
        docs.select(i.alias("id"), F.col(f"`{source}`").alias("source"), word_count(t).alias("size"), place(i, t).alias("u")),
        f"{path}/sizes",
    )
    sizes = told_apart(sizes, f"{path}/copies")
    rates, n_sources = mixing_rates(sizes, path, most)
    out = with_source(sizes, rates, n_sources, "source_size", "target", "rate", "whole", "takes")
    return out.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "rate", copies().alias("copies")
    )


def place(id_: Column, text: Column) -> Column:
    """A document's place in the order in which its source's last copies are given out."""
    return _place(id_.cast("string"), F.coalesce(text, F.lit("")))


def told_apart(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with places ``u`` of their own for repeated rows of a source: the hash of ``u`` and their number.

    Numbers run over partitions, each of which counts its own rows of a place, from where the
    partitions before it stopped; no task sees all copies. Rows that are not repeated keep their place."""
    names = rows.columns
    counts = rows.groupBy("source", "u").agg(F.count("*").alias("n")).filter("n > 1")
    again = stored(counts.select(F.col("source").alias("_s"), F.col("u").alias("_u")), f"{path}/repeated")
    if again.isEmpty():
        return rows
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("u") == F.col("_u"))
    marked = rows.withColumns({"_pid": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).join(again, same, "left")
    marked = stored(marked, f"{path}/marked")
    copies = marked.filter("_u IS NOT NULL").drop("_s", "_u")
    per = copies.groupBy(F.col("source").alias("_s"), F.col("u").alias("_u"), F.col("_pid").alias("_p")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("_s", "_u").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per = stored(per.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), f"{path}/starts")
    own = Window.partitionBy("source", "u", "_pid").orderBy("_at")
    numbered = stored(copies.withColumn("_n", F.row_number().over(own)), f"{path}/numbered")
    numbered = numbered.join(per, same & (F.col("_pid") == F.col("_p"))).withColumn("u", _place(F.col("u"), F.col("_start") + F.col("_n")))
    return marked.filter("_u IS NULL").select(names).union(numbered.select(names))


def _place(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - HASH_BITS)


def took() -> Column:
    """Whether a document (size, u) gets one copy more, by its source's ``takes``."""
    return F.exists("takes", lambda p: (F.col("size") <= p["need"]) & (F.col("u") < p["limit"]))


def copies() -> Column:
    return (F.col("whole") + F.when(took() & (F.col("size") > 0), 1).otherwise(0)).cast("long")


def repeated(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", source: str = "source", most: int = 3
) -> DataFrame:
    """``docs`` mixed: every row as many times as it has copies, columns unchanged."""
    path = path or shared_dir(docs.sparkSession, "mixing")
    names = [f"_{i}" for i in range(len(docs.columns))]
    i, t, s = (F.col(names[docs.columns.index(c)]) for c in (id_col, text, source))
    rows = docs.toDF(*names).withColumns({"source": s, "size": word_count(t), "u": place(i, t)})
    rows = told_apart(rows, f"{path}/copies")
    rates, n_sources = mixing_rates(stored(rows.select("source", "size", "u"), f"{path}/sizes"), path, most)
    out = with_source(rows, rates, n_sources, "whole", "takes").withColumn("copies", copies()).filter("copies > 0")
    return out.select(*names, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(names).toDF(*docs.columns)


def mixing_rates(sizes: DataFrame, path: str, most: int) -> tuple[DataFrame, int]:
    """Per source: source_size, target, rate, whole (copies that all its documents get) and
    takes, which documents get one more; and the number of sources. ``sizes``: source,
    size, u."""
    rates = balance(source_targets(sizes, float(most), f"{path}/targets"), f"{path}/dual")
    n_sources = rates.count()
    rate = F.least(F.exp("tilt"), F.lit(float(most)))
    rates = rates.withColumn("rate", rate).withColumn("whole", F.floor(rate + 1e-9))
    rates = rates.withColumn("need", F.greatest(F.lit(0), F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5)))
    rates = rates.withColumn("need", F.when(F.col("whole") < most, F.col("need")).otherwise(F.lit(0)))
    rates = stored(rates.withColumn("takes", F.array().cast("array<struct<need:bigint,limit:bigint>>")), f"{path}/rates")
    for p in range(PASSES):
        rest = with_source(sizes.filter("size > 0").select("source", "size", "u"), rates, n_sources, "need", "takes")
        rest = rest.filter((F.col("size") <= F.col("need")) & ~took()).select("source", "size", "u")
        found = hash_limits(rest, rates, n_sources, f"{path}/pass-{p}").withColumnRenamed("source", "_s")
        joined = rates.join(found, F.col("source").eqNullSafe(F.col("_s")))
        more = F.array(F.struct("need", "limit"))
        rates = stored(
            joined.withColumn("takes", F.concat("takes", more)).withColumn("need", F.col("need") - F.col("used")).drop("_s", "limit", "used"),
            f"{path}/rates-{p}",
        )
    return rates, n_sources
