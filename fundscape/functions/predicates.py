"""Text predicates. They stay NULL on NULL text so that a filter can push them into
the scan; ``holds`` and ``lacks`` give the two-valued forms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    return reduce(or_, [col.startswith(p) for p in prefixes], F.lit(False))


def matches_any(col: Column, pattern: str) -> Column:
    """Case-insensitive search with Unicode letters and word boundaries."""
    return col.rlike("(?iU)" + pattern)


def contains_any(col: Column, stems: Sequence[str]) -> Column:
    lowered = F.lower(col)
    return reduce(or_, [lowered.contains(s) for s in stems], F.lit(False))


def holds(predicate: Column) -> Column:
    """True where the predicate is true, False where it is false or NULL."""
    return F.coalesce(predicate, F.lit(False))


def lacks(predicate: Column) -> Column:
    """The complement of ``holds``: rows with NULL text are kept."""
    return ~holds(predicate)
