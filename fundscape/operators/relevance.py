"""Choosing the projects that matter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.constants import CLIMATE_PATTERN, TOPIC_PREFIXES
from fundscape.functions import matches_any, starts_with_any


def select_relevant(
    projects: DataFrame,
    topic_col: str = "topics",
    prefixes: Sequence[str] = TOPIC_PREFIXES,
    text_col: str = "objective",
    pattern: str = CLIMATE_PATTERN,
) -> DataFrame:
    """Projects whose topic has one of the prefixes or whose text matches the pattern.

    The two sets are disjoint by construction, so one filter over one scan stands for
    their union. A NULL topic or text decides nothing by itself."""
    by_topic = starts_with_any(F.col(topic_col), prefixes)
    by_text = matches_any(F.col(text_col), pattern)
    return projects.filter(by_topic | by_text)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column; NULL counts as one."""
    return df.select(col).distinct()
