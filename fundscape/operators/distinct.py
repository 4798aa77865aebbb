"""Distinct counts that merge: sketches, and bitmaps over whole-number ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.operators.features import with_success_ratio

LOG_SIZE = 12  # 2^12 registers, about 2.5 kB a sketch
# Three standard errors, 3 * 1.04 / sqrt(2^12): what an estimate may be off by.
ERROR_BOUND = 3 * 1.04 / 2 ** (LOG_SIZE / 2)
WIDTH = 32_768  # ids in a bitmap


def value_sketches(df: DataFrame, group: Sequence[str], value: str, log_size: int = LOG_SIZE) -> DataFrame:
    """One sketch of the distinct values per group: (group, sketch). Sketches of parts of the data, days
    say, are stored and united when read."""
    known = df.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in [*group, value]))
    return known.groupBy(*group).agg(F.hll_sketch_agg(F.col(value).cast("string"), log_size).alias("sketch"))


def united_sketches(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """The sketches of several slices as one per group."""
    return sketches.groupBy(*group).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_estimates(sketches: DataFrame, out: str = "estimate") -> DataFrame:
    """The estimated number of distinct values in place of the sketch."""
    return sketches.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")


def id_bitmaps(df: DataFrame, group: str, ids: Sequence[str], plain: dict | None = None) -> DataFrame:
    """(group, id, bucket, bits and the ``plain`` aggregates): which ids occur, as bitmaps of 32,768
    neighbouring ids. Each row counts for every id column, so plain aggregates are taken
    with the first of them only. Stored bitmaps of several days merge with ``merged_bitmaps``.

    Ids must be whole numbers from 0. A bitmap takes 4 kB (much less compressed) however
    many ids it holds, so this suits dense ids, and best data in the order of its ids."""
    first = ids[0]
    marks = F.array(*[
        F.struct(F.lit(c).alias("id"), F.bitmap_bucket_number(F.col(c) + 1).alias("bucket"), F.bitmap_bit_position(F.col(c) + 1).alias("bit"))
        for c in ids
    ])
    rows = df.filter(F.col(group).isNotNull()).select("*", F.inline(marks))
    metrics = [column.alias(name) for name, column in (plain or {}).items()]
    only = rows.withColumn("_first", F.col("id") == first)
    return only.groupBy(group, "id", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"), *metrics)


def merged_bitmaps(bitmaps: DataFrame, group: str) -> DataFrame:
    """Bitmaps of several slices as one per group, id and bucket."""
    return bitmaps.groupBy(group, "id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, group: str, ids: dict[str, str]) -> DataFrame:
    """Distinct ids per group; ``ids``: id column -> name of its count."""
    counts = [F.coalesce(F.sum(F.when(F.col("id") == c, F.bitmap_count("bits"))), F.lit(0)).alias(name) for c, name in ids.items()]
    return bitmaps.groupBy(group).agg(*counts)


def bitmap_features(
    df: DataFrame,
    group_col: str = "country",
    project_col: str = "projectID",
    org_col: str = "organisationID",
    amount_col: str = "ecContribution",
    status_col: str = "status",
    flag_col: str = "is_collab",
) -> DataFrame:
    """``group_features`` for whole-number ids, without copies of each row for its distinct counts:
    sums and counts ride with the projects' bitmaps, and bitmaps merge before the shuffle."""
    once = F.col("_first")
    status = F.upper(status_col)
    parts = {
        "amount": F.sum(F.when(once, F.col(amount_col))),
        "n": F.count_if(once),
        "flagged": F.sum(F.when(once, F.col(flag_col).cast("double"))),
        "flags": F.count(F.when(once, F.col(flag_col))),
        **{s.lower(): F.count_if(once & (status == s)) for s in ("SIGNED", "CLOSED", "TERMINATED")},
    }
    bitmaps = id_bitmaps(df, group_col, [project_col, org_col], parts)
    counts = [
        F.sum(F.when(F.col("id") == c, F.bitmap_count("bits"))).alias(name) for c, name in ((project_col, "total_projects"), (org_col, "unique_orgs"))
    ]
    grouped = bitmaps.groupBy(group_col).agg(
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_ec_contribution"),
        *[F.coalesce(c, F.lit(0)).alias(name) for c, name in zip(counts, ("total_projects", "unique_orgs"), strict=True)],
        F.try_divide(F.sum("flagged"), F.sum("flags")).alias("collab_project_ratio"),
        *[F.try_divide(F.sum(s), F.sum("n")).alias(f"{s}_pct") for s in ("signed", "closed", "terminated")],
    )
    return with_success_ratio(grouped)
