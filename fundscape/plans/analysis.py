"""The whole analysis as four named stages over stored tables.

Each stage is a plain function from DataFrames to DataFrames; ``run`` stores what a
stage gives before the next one reads it, so later stages start from files, can be run
alone, and lose nothing when an executor goes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.constants import (
    CLIMATE_PATTERN,
    EU_MEMBERS,
    METRICS,
    PHRASE_STEMS,
    PROJECTION_PEERS,
    PROJECTION_SHOCKS,
    SCORE_WEIGHTS,
    TOPIC_PREFIXES,
)
from fundscape.operators.explain import embedding_2d, feature_importance
from fundscape.operators.features import (
    alias_codes,
    group_features,
    join_denominator,
    keep_members,
    participation_shares,
    preprocess_gdp,
)
from fundscape.operators.keyphrases import extract_keyphrases
from fundscape.operators.models import fit_report
from fundscape.operators.participation import flagged_participations, parse_money
from fundscape.operators.projection import project_scores, projection_report
from fundscape.operators.relevance import distinct_values, select_relevant
from fundscape.operators.scoring import (
    ensure_score,
    minmax_scale,
    quantile_bins,
    ramp_position,
    ranked,
    row_mean,
    weighted_sum,
    with_average_row,
)
from fundscape.sources import iso_codes, read_stage, value_list, write_artifact

SCALED = tuple(SCORE_WEIGHTS)


def base_features(flagged: DataFrame, gdp: DataFrame, members: Sequence[str] | DataFrame = EU_MEMBERS) -> DataFrame:
    """Totals, ratios and the denominator, for members only. Members are chosen before
    the join, which gives the same rows."""
    return join_denominator(keep_members(group_features(flagged), members), gdp)


def country_features(
    flagged: DataFrame,
    gdp: DataFrame,
    members: Sequence[str] | DataFrame = EU_MEMBERS,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Features, shares, scaled metrics and the equal-weight score of each member.
    Collaboration was decided over all countries; shares and scales are over members.
    Shares and scales read the base table several times; ``hold`` may store it."""
    base = hold(base_features(flagged, gdp, members))
    return row_mean(minmax_scale(participation_shares(base), METRICS), SCALED)


def scored_countries(features: DataFrame) -> DataFrame:
    """Features with both scores."""
    return weighted_sum(ensure_score(features))


def weighted_table(scored: DataFrame) -> DataFrame:
    """The scored table with its average row and ramp."""
    return ramp_position(with_average_row(scored))


def country_scores(weighted: DataFrame) -> DataFrame:
    """Scores for export, best first."""
    return ranked(weighted.select("country", "Weighted_Score", "ramp", "is_average"), "Weighted_Score", "country")


def merge_stage(
    projects: DataFrame,
    orgs: DataFrame,
    prefixes: Sequence[str] = TOPIC_PREFIXES,
    pattern: str = CLIMATE_PATTERN,
    aliases: Mapping[str, str] | DataFrame | None = None,
) -> DataFrame:
    """Participations of the relevant projects with their collaboration flag, which is
    found here, from (project, country) pairs, so that later stages need no join for it."""
    if aliases is not None:
        orgs = alias_codes(orgs, aliases)
    return flagged_participations(orgs, select_relevant(projects, prefixes=prefixes, pattern=pattern))


STAGES = ("data_preprocessing", "feature_selection", "text_analysis", "future_projections")


def run(
    spark: SparkSession,
    out: str,
    projects: DataFrame | None = None,
    orgs: DataFrame | None = None,
    gdp: DataFrame | None = None,
    stages: Sequence[str] = STAGES,
    codes: DataFrame | None = None,
    members: Sequence[str] | DataFrame = EU_MEMBERS,
    prefixes: Sequence[str] = TOPIC_PREFIXES,
    pattern: str = CLIMATE_PATTERN,
    stop_words: Sequence[str] | None = None,
    stems: Sequence[str] = PHRASE_STEMS,
    pairs: Mapping[str, str] | DataFrame = PROJECTION_PEERS,
    shocks: Mapping[int, str] | DataFrame = PROJECTION_SHOCKS,
    draws: int = 1,
    aliases: Mapping[str, str] | DataFrame | None = None,
) -> None:
    """Run the stages named, reading earlier results from ``out``.

    The first stage needs the three inputs; the others need only the tables that
    earlier runs stored."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; there are {STAGES}")

    def store(df: DataFrame, name: str, fmt: str = "parquet") -> None:
        write_artifact(df, f"{out.rstrip('/')}/{name}", fmt)

    def load(name: str) -> DataFrame:
        return read_stage(spark, out, name)

    if codes is None:
        codes = iso_codes(spark)
    if "data_preprocessing" in stages:
        store(merge_stage(projects, orgs, prefixes, pattern, aliases), "projects_preprocessed")
        store(preprocess_gdp(gdp, codes), "gdp_preprocessed")
        store(value_list(spark, members, "country"), "eu_iso2")
        store(distinct_values(load("projects_preprocessed"), "status"), "project_statuses")
    if "feature_selection" in stages:
        flagged = parse_money(load("projects_preprocessed"))
        store(base_features(flagged, load("gdp_preprocessed"), load("eu_iso2")), "country_base")
        features = minmax_scale(participation_shares(load("country_base")), METRICS)
        store(row_mean(features, SCALED), "country_features")
        scored = scored_countries(load("country_features"))
        placed = quantile_bins(embedding_2d(scored), "Weighted_Score", out="quintile")
        store(weighted_table(placed), "country_features_weighted")
        store(country_scores(load("country_features_weighted")), "country_scores", "json")
        store(feature_importance(load("country_features")), "feature_importance", "json")
        weighted = feature_importance(scored_countries(load("country_features")), label="Weighted_Score", seed=42)
        store(weighted, "feature_importance_weighted")
        store(fit_report(scored_countries(load("country_features")), trees=20), "score_models")
    if "text_analysis" in stages:
        phrases = extract_keyphrases(load("projects_preprocessed"), stop_words=stop_words, stems=stems)
        store(phrases, "project_keyphrases", "json")
    if "future_projections" in stages:
        paths = project_scores(load("country_features_weighted"), pairs, shocks, draws=draws)
        names = codes.select(F.col("iso2"), F.col("country_name"))
        store(projection_report(paths, shocks, names), "country_projections", "json")
