"""Scenario projection: what a score does when a country catches up with a peer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscape.constants import EXPLANATION, PROJECTION_PEERS, PROJECTION_SHOCKS, STATED_RATE, SUMMARIES
from fundscape.functions import clip, fill_template, normal, uniform
from fundscape.sources.lookups import parameter_table

STEP = 0.01


def peer_lookup(
    scores: DataFrame,
    pairs: Mapping[str, str] | DataFrame = PROJECTION_PEERS,
    rate: float = 0.95,
    key: str = "country",
    score: str = "Weighted_Score",
) -> DataFrame:
    """Scores of each country and its peer, and the target between them:
    ``(country, peer, low_score, top_score, target_score)``. A country without a row in
    the scores fails the query."""
    spark = scores.sparkSession
    table = parameter_table(spark, pairs, "country string, peer string")
    low = scores.select(F.col(key).alias("country"), F.lit(True).alias("_low"), F.col(score).alias("low_score"))
    top = scores.select(F.col(key).alias("peer"), F.lit(True).alias("_top"), F.col(score).alias("top_score"))
    joined = table.join(low, "country", "left").join(top, "peer", "left")

    def present(flag: str, name: str, value: str) -> Column:
        missing = F.raise_error(F.concat(F.lit("no score for "), F.coalesce(name, F.lit("NULL"))))
        return F.when(F.col(flag).isNull(), missing).otherwise(F.col(value))

    return joined.select(
        "country",
        "peer",
        present("_low", "country", "low_score").alias("low_score"),
        present("_top", "peer", "top_score").alias("top_score"),
    ).withColumn(
        "target_score", F.col("low_score") + F.lit(rate) * (F.col("top_score") - F.col("low_score"))
    )


def year_spine(df: DataFrame, n_years: int = 26, start_year: int = 2025) -> DataFrame:
    """One row per input row and year, with the step number ``i`` from 0."""
    years = F.sequence(F.lit(start_year), F.lit(start_year + n_years - 1))
    return df.select("*", F.explode(years).alias("year")).withColumn("i", F.col("year") - start_year)


def with_glide(df: DataFrame, n_years: int = 26, out: str = "glide") -> DataFrame:
    """Progress of each year and the straight line from low score to target."""
    progress = F.col("i") / F.lit(n_years - 1) if n_years > 1 else F.lit(0.0)
    spread = F.col("target_score") - F.col("low_score")
    return df.withColumn("progress", progress).withColumn(out, F.col("low_score") + F.col("progress") * spread)


def with_draws(df: DataFrame, draws: int = 1) -> DataFrame:
    return df.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))


def current_walk(
    seed: int = 123, n_years: int = 26, start_year: int = 2025, keys: Sequence[str] = ("country", "draw")
) -> Column:
    """Clipped random walk from the low score, as an array with one value per year.

    Clipping makes each step depend on the last one, so it is a fold over the years of
    a row; nothing is shuffled."""
    if n_years == 1:
        return F.array("low_score")
    later = F.sequence(F.lit(start_year + 1), F.lit(start_year + n_years - 1))

    def step(path: Column, year: Column) -> Column:
        noise = normal([*[F.col(k) for k in keys], year], seed, "current") * F.lit(STEP)
        return F.array_append(path, clip(F.element_at(path, -1) + noise))

    return F.aggregate(later, F.array("low_score"), step)


def project_scores(
    scores: DataFrame,
    pairs: Mapping[str, str] | DataFrame = PROJECTION_PEERS,
    shocks: Mapping[int, str] | DataFrame = PROJECTION_SHOCKS,
    rate: float = 0.95,
    shock_range: tuple[float, float] = (0.02, 0.06),
    seed: int = 123,
    n_years: int = 26,
    start_year: int = 2025,
    draws: int = 1,
    key: str = "country",
    score: str = "Weighted_Score",
) -> DataFrame:
    """Yearly paths ``(country, peer, draw, year, i, score_current, score_improved)``.

    The first point of both is the present score. The improved path is the glide line
    plus noise that fades out, minus a random setback in shock years."""
    base = with_draws(peer_lookup(scores, pairs, rate, key, score), draws)
    paths = base.withColumn("_walk", current_walk(seed, n_years, start_year))
    yearly = with_glide(year_spine(paths, n_years, start_year), n_years)
    yearly = yearly.withColumn("score_current", F.get("_walk", F.col("i"))).drop("_walk")
    return with_improved(yearly, shocks, shock_range, seed).select(
        "country", "peer", "draw", "year", "i", "score_current", "score_improved"
    )


def with_improved(
    yearly: DataFrame,
    shocks: Mapping[int, str] | DataFrame = PROJECTION_SHOCKS,
    shock_range: tuple[float, float] = (0.02, 0.06),
    seed: int = 123,
    keys: Sequence[str] = ("country", "draw"),
) -> DataFrame:
    """Add ``score_improved`` to yearly rows that have a glide value and progress."""
    spark = yearly.sparkSession
    table = parameter_table(spark, shocks, "year int, label string")
    cells = [F.col(k) for k in keys] + [F.col("year")]
    least, most = shock_range
    fading = normal(cells, seed, "improved") * F.lit(STEP) * (F.lit(1.0) - F.col("progress"))
    size = F.lit(least) + F.lit(most - least) * uniform(cells, seed, "shock")
    setback = F.when(F.col("label").isNotNull(), size).otherwise(0.0)
    later = clip(F.col("glide") + fading - setback)
    joined = yearly.join(table, "year", "left")
    return joined.withColumn("score_improved", F.when(F.col("i") == 0, F.col("low_score")).otherwise(later)).drop(
        "label"
    )


def explanation(
    country: Column, peer: Column, shock_text: Column, stated_rate: int = STATED_RATE, template: str = EXPLANATION
) -> Column:
    """Explanation text. The rate it states is an argument of its own."""
    return fill_template(template, country=country, peer=peer, rate=F.lit(stated_rate), shocks=shock_text)


def shock_text(spark, shocks: Mapping[int, str] | DataFrame = PROJECTION_SHOCKS) -> Column:
    """``year – label`` of every shock in order of years, joined by commas, as a scalar
    subquery over the parameter table."""
    table = parameter_table(spark, shocks, "year int, label string")
    ordered = F.array_sort(F.collect_list(F.struct("year", "label")))
    parts = F.transform(ordered, lambda s: F.concat(s["year"].cast("string"), F.lit(" – "), s["label"]))
    return table.agg(F.array_join(parts, ", ").alias("shocks")).scalar()


def projection_report(
    paths: DataFrame,
    shocks: Mapping[int, str] | DataFrame = PROJECTION_SHOCKS,
    names: Mapping[str, str] | DataFrame = (),
    summaries: Mapping[str, str] | DataFrame = SUMMARIES,
    stated_rate: int = STATED_RATE,
) -> DataFrame:
    """One row per country and draw: arrays over the years, the peer's name, the
    explanation and the prepared summary (empty where there is none).

    A group holds one value per year of the horizon, so its size is a parameter."""
    spark = paths.sparkSession
    year = F.struct("year", "score_current", "score_improved")
    series = paths.groupBy("country", "peer", "draw").agg(F.array_sort(F.collect_list(year)).alias("_s"))
    named = parameter_table(spark, dict(names) if not isinstance(names, DataFrame) else names, "code string, name string")
    own = named.toDF("country", "_country_name")
    peers = named.toDF("peer", "_peer_name")
    notes = parameter_table(spark, summaries, "country string, _summary string").toDF("country", "_summary")
    joined = series.join(own, "country", "left").join(peers, "peer", "left").join(notes, "country", "left")
    country_name = F.coalesce("_country_name", "country")
    peer_name = F.coalesce("_peer_name", "peer")
    return joined.select(
        "country",
        "draw",
        F.col("_s.year").alias("years"),
        F.col("_s.score_current").alias("score_current"),
        F.col("_s.score_improved").alias("score_improved"),
        peer_name.alias("top_country"),
        explanation(country_name, peer_name, shock_text(spark, shocks), stated_rate).alias("explanation"),
        F.coalesce("_summary", F.lit("")).alias("summary"),
    )


def projection_series(report: DataFrame) -> DataFrame:
    """Chart rows of a report: one per country, draw and year."""
    zipped = F.arrays_zip("years", "score_current", "score_improved")
    rows = report.select("country", "draw", F.inline(zipped))
    return rows.withColumnRenamed("years", "year")


def projection_annotations(report: DataFrame, shocks: Mapping[int, str] = PROJECTION_SHOCKS) -> DataFrame:
    """Shocks within each row's years, placed at the highest value of both series."""
    height = F.greatest(F.array_max("score_current"), F.array_max("score_improved"))
    listed = F.array(*[F.struct(F.lit(y).alias("year"), F.lit(s).alias("label")) for y, s in shocks.items()])
    first, last = F.get("years", F.lit(0)), F.element_at("years", -1)
    in_range = F.filter(listed, lambda s: s["year"].between(first, last))
    return report.select("country", "draw", height.alias("height"), F.inline(in_range)).select(
        "country", "draw", "year", "label", "height"
    )
