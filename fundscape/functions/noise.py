"""Noise as a function of a key, so that it depends on neither partitioning nor
execution order and survives recomputation after a lost executor."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(keys: Sequence[Column], seed: int, stream: str) -> Column:
    """Uniform on (0, 1) from the first 32 bits of an MD5 of key, stream and seed."""
    parts = [k.cast("string") for k in keys] + [F.lit(stream), F.lit(str(seed))]
    word = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10)
    return (word.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)


def normal(keys: Sequence[Column], seed: int, stream: str) -> Column:
    """Standard normal by the Box-Muller transform of two uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(keys, seed, stream + "/r")))
    return radius * F.cos(F.lit(2 * pi) * uniform(keys, seed, stream + "/a"))
