"""Exact interpolated quantiles of a column of any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a stretch that the driver may read, and how closely a round aims.
FEW = 10_000
ACCURACY = 10_000


@dataclass
class Stretch:
    """Where the value of a rank lies: strictly between ``low`` and ``high`` (None: no
    bound), with ``before`` values at or below ``low`` and ``inside`` between them."""

    rank: int
    before: int
    inside: int
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        v = F.col("v")
        within = F.lit(True)
        if self.low is not None:
            within = within & (v > self.low)
        if self.high is not None:
            within = within & (v < self.high)
        return within


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], few: int = FEW, accuracy: int = ACCURACY) -> list[float]:
    """Linearly interpolated quantiles, like ``DataFrame.approxQuantile`` but exact.

    Every wanted rank has a stretch of values it lies in. A round takes two approximate
    quantiles close around the rank, counts exactly what lies below, on and between them,
    and goes on in the part that holds the rank: the value itself if the rank falls on one
    of the two, else a stretch with a small share of the rows. Stretches of few rows are
    read. Rounds are plain aggregations, so no task holds or sorts a share of the data; the
    driver sees counts, bounds and at most ``few`` rows for each rank. NULL and NaN are no values."""
    values = df.select(F.col(col).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    n = values.count()
    if not n:
        raise ValueError(f"{col} has no values")
    positions = [(n - 1) * p for p in probs]
    left = [Stretch(r, 0, n) for r in sorted({r for x in positions for r in (floor(x), ceil(x))})]
    found: dict[int, float] = {}
    while left:
        found |= _read(values, [s for s in left if s.inside <= few])
        left = _narrow(values, [s for s in left if s.inside > few], accuracy, found)
    edges = []
    for x in positions:
        low, high = floor(x), ceil(x)
        edges.append(found[low] if low == high else (high - x) * found[low] + (x - low) * found[high])
    return edges


def _read(values: DataFrame, stretches: list[Stretch]) -> dict[int, float]:
    """The values at ranks whose stretches are short."""
    found = {}
    if stretches:
        wanted = F.lit(False)
        for s in stretches:
            wanted = wanted | s.holds()
        counts = sorted((r["v"], r["count"]) for r in values.filter(wanted).groupBy("v").count().collect())
        for s in stretches:
            at = s.before
            for v, c in counts:
                if (s.low is None or v > s.low) and (s.high is None or v < s.high):
                    at += c
                    if at > s.rank:
                        found[s.rank] = v
                        break
    return found


def _narrow(values: DataFrame, stretches: list[Stretch], accuracy: int, found: dict[int, float]) -> list[Stretch]:
    """One round for long stretches; ranks that fall on a bound go to ``found``."""
    if not stretches:
        return []
    near = [
        F.percentile_approx(F.when(s.holds(), F.col("v")), F.array(*[F.lit(min(max(p, 0.0), 1.0)) for p in (at - 1 / accuracy, at + 1 / accuracy)]), accuracy)
        for s in stretches
        for at in [(s.rank - s.before + 0.5) / s.inside]
    ]
    bounds = values.agg(*near).first()
    v, counts = F.col("v"), []
    for a, b in bounds:
        counts += [F.count_if(v < a), F.count_if(v == a), F.count_if((v > a) & (v < b)), F.count_if(v == b)]
    numbers, left = values.agg(*counts).first(), []
    for i, (s, (a, b)) in enumerate(zip(stretches, bounds, strict=True)):
        below, on_a, between, on_b = numbers[4 * i : 4 * i + 4]
        upto = below + on_a + between
        if s.rank < below:
            left.append(Stretch(s.rank, s.before, below - s.before, s.low, a))
        elif s.rank < below + on_a:
            found[s.rank] = a
        elif s.rank < upto:
            left.append(Stretch(s.rank, below + on_a, between, a, b))
        elif a != b and s.rank < upto + on_b:
            found[s.rank] = b
        else:
            past = upto + (on_b if a != b else 0)
            left.append(Stretch(s.rank, past, s.before + s.inside - past, b, s.high))
    return left
