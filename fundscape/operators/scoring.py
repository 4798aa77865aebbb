"""Scaling, scoring, bins, ranks and the average row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscape.constants import AVERAGE_LABEL, METRICS, SCORE_WEIGHTS
from fundscape.operators.features import with_totals
from fundscape.operators.quantiles import exact_quantiles


def minmax_scale(df: DataFrame, cols: Sequence[str] = METRICS, suffix: str = "_scaled") -> DataFrame:
    """Scale columns to [0, 1] by their minimum and maximum. A constant column gives 0,
    NULL stays NULL. All extremes come from one aggregation."""
    limits = {f"{side}_{c}": fn(c) for c in cols for side, fn in (("low", F.min), ("high", F.max))}

    def scaled(c: str):
        return lambda t: position(F.col(c), t[f"low_{c}"], t[f"high_{c}"])

    return with_totals(df, df, limits, {c + suffix: scaled(c) for c in cols})


def position(x: Column, low: Column, high: Column) -> Column:
    """Where x lies between two limits, 0 where they coincide."""
    return F.when(x.isNotNull(), F.coalesce(F.try_divide(x - low, high - low), F.lit(0.0)))


def row_mean(df: DataFrame, cols: Sequence[str], out: str = "Score") -> DataFrame:
    """Mean of a row's values without its NULLs."""
    total = reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    present = reduce(add, [F.when(F.col(c).isNull(), 0).otherwise(1) for c in cols])
    return df.withColumn(out, F.try_divide(total, present))


def ensure_score(df: DataFrame, cols: Sequence[str] = tuple(SCORE_WEIGHTS), out: str = "Score") -> DataFrame:
    """The equal-weight score, added only when it is absent."""
    return df if out in df.columns else row_mean(df, cols, out)


def weighted_sum(
    df: DataFrame, weights: Mapping[str, float] = SCORE_WEIGHTS, out: str = "Weighted_Score"
) -> DataFrame:
    """Weighted sum of columns; one NULL makes it NULL."""
    return df.withColumn(out, reduce(add, [F.col(c) * F.lit(w) for c, w in weights.items()]))


def quantile_bins(df: DataFrame, col: str, n: int = 5, out: str = "bin") -> DataFrame:
    """Bins 0 to n-1 by exact interpolated quantiles, closed on the right, the lowest
    value included. NULL and NaN have no bin. Coinciding edges raise ``ValueError``."""
    edges = exact_quantiles(df, col, [i / n for i in range(n + 1)])
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"bin edges of {col} must differ: {edges}")
    x = F.col(col)
    above = reduce(add, [F.when(x > F.lit(e), 1).otherwise(0) for e in edges[1:-1]], F.lit(0))
    return df.withColumn(out, F.when(x.isNotNull() & ~F.isnan(x.cast("double")), above))


def bin_labels(df: DataFrame, bin_col: str, labels: Sequence[str], out: str = "label") -> DataFrame:
    """Label of each bin by its number."""
    return df.withColumn(out, F.get(F.array(*[F.lit(v) for v in labels]), F.col(bin_col)))


def with_average_row(
    df: DataFrame, key: str = "country", label: str = AVERAGE_LABEL, col: str = "Weighted_Score"
) -> DataFrame:
    """Append one row holding the column's mean; its other columns are NULL."""
    average = df.agg(F.avg(col).alias(col)).withColumn(key, F.lit(label))
    return df.unionByName(average, allowMissingColumns=True)


def ramp_position(
    df: DataFrame,
    col: str = "Weighted_Score",
    key: str = "country",
    label: str = AVERAGE_LABEL,
    out: str = "ramp",
) -> DataFrame:
    """Position of each score between the least and the greatest of the countries. The
    average row is flagged, has no position and does not move the limits."""
    average = F.coalesce(F.col(key) == label, F.lit(False))
    limits = {"low": F.min(F.when(~average, F.col(col))), "high": F.max(F.when(~average, F.col(col)))}
    place = {out: lambda t: F.when(~average, position(F.col(col), t["low"], t["high"]))}
    return with_totals(df, df, limits, place).withColumn("is_average", average)


def ranked(df: DataFrame, by: str, tie: str) -> DataFrame:
    """Sorted by a column from high to low, NULL last, ties by another column."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(tie))


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The first ``k`` rows of that order; each task keeps only its own ``k`` best."""
    return ranked(df, by, tie).limit(k)
