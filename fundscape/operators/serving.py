"""Tables behind the dashboard's figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.constants import COUNTRY_NAMES
from fundscape.operators.features import map_codes, share_of_total
from fundscape.operators.scoring import ranked, top_k
from fundscape.sources.lookups import parameter_table


def term_counts(phrases: DataFrame, term: str = "term", ordered: bool = True) -> DataFrame:
    """How often each term occurs, most frequent first. That order sorts every term there is; leave
    it out where only the first few are wanted."""
    counts = phrases.groupBy(term).agg(F.count("*").alias("count"))
    return ranked(counts, "count", term) if ordered else counts


def top_terms(counts: DataFrame, k: int = 100, term: str = "term", count: str = "count") -> DataFrame:
    """The ``k`` most frequent terms."""
    return top_k(counts, count, k, term)


def importance_percent(importance: DataFrame, value: str = "importance", out: str = "percent") -> DataFrame:
    """Each label's percentage of the whole."""
    return share_of_total(importance, value, out, scale=100.0)


def ranked_contributions(
    scores: DataFrame,
    names: Mapping[str, str] | DataFrame = COUNTRY_NAMES,
    key: str = "country",
    score: str = "Weighted_Score",
) -> DataFrame:
    """Scores from high to low with full names, the code standing in for a missing one."""
    table = parameter_table(scores.sparkSession, names, "code string, name string")
    return ranked(map_codes(scores, key, table, "full_name", fallback=True), score, key)
