"""Registered queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.constants import METRICS, PROJECTION_SHOCKS
from fundscape.functions import holds, lacks, matches_any, parse_eu_number, starts_with_any, to_number, tokens, uniform
from fundscape.operators import (
    clusters,
    distinct,
    explain,
    features,
    keyphrases,
    models,
    participation,
    projection,
    relevance,
    scoring,
    serving,
    vectors,
)
from fundscape.plans import analysis, views
from fundscape.session import scratch_path, stored
from fundscape.sources import (
    mark_missing,
    read_json_shape,
    read_stage,
    read_table,
    records_from_json,
    rows_from_json_columns,
    rows_from_json_map,
    schemas,
    with_position,
    write_artifact,
    write_bucketed,
    write_single_file,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOTES = {"NATION_0": "Prepared summary of nation 0.", "NATION_1": "Prepared summary of nation 1."}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round doubles so that the order of summation does not show."""
    return df.select(
        *[
            F.round(F.col(f"`{n}`"), 2 if n.startswith(("total_ec", "gdp")) else places).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


# -- relevance ---------------------------------------------------------------------


@query
def prefix_filter(spark, sf):
    p = views.projects(spark, sf)
    return p.filter(starts_with_any(F.col("topics"), views.PREFIXES)).select("id", "topics")


@query
def prefix_complement(spark, sf):
    p = views.projects(spark, sf)
    return p.filter(lacks(starts_with_any(F.col("objective"), ("The", "Un")))).select("id", "topics")


@query
def keyword_relevance(spark, sf):
    d = views.texts(spark, sf)
    return d.select("doc_id", holds(matches_any(F.col("text"), views.PATTERN)).alias("relevant"))


@query
def relevant_projects(spark, sf):
    return views.relevant(spark, sf).select("id", "topics", "objective", "status")


@query
def distinct_statuses(spark, sf):
    return relevance.distinct_values(views.projects(spark, sf), "status")


# -- scalars -----------------------------------------------------------------------


@query
def parse_money(spark, sf):
    """Prices written the European and the English way, and parsed again."""
    lines = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    english = lines.withColumn("english", F.format_number("l_extendedprice", 2))
    written = english.withColumns(
        {
            "european": F.concat(F.lit("€ "), F.translate("english", ",.", ".,")),
            "commas": F.translate("english", ".", ","),
        }
    )
    return written.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        *[parse_eu_number(F.col(c)).alias("from_" + c) for c in ("european", "english", "commas")],
    )


@query
def gdp_preprocess(spark, sf):
    """Customers as an indicator table with some unusable values; a code maps to the
    nation five places before, so the first codes have none."""
    customers = views.table(spark, sf, "customer")
    value = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    raw = customers.select(
        "c_custkey",
        F.concat(F.lit("C"), F.col("c_nationkey")).alias("Country Code"),
        value.alias("2023"),
    )
    codes = views.table(spark, sf, "nation").select(
        F.concat(F.lit("C"), F.col("n_nationkey") + 5).alias("iso3"), F.col("n_name").alias("iso2")
    )
    ready = features.preprocess_gdp(raw, codes)
    return ready.select("c_custkey", F.col("Country Code").alias("code"), "iso2", F.col("2023").alias("gdp_2023"))


@query
def code_lookup(spark, sf):
    """Suppliers' nations by name; those without one keep NULL or their code."""
    suppliers = views.table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("code"))
    codes = views.table(spark, sf, "nation").select((F.col("n_nationkey") + 5).cast("string"), "n_name")
    looked = features.map_codes(suppliers, "code", codes, "name")
    return features.map_codes(looked, "code", codes, "name_or_code", fallback=True)


@query
def noise_uniform(spark, sf):
    keys = views.table(spark, sf, "orders").select("o_orderkey")
    return keys.select("o_orderkey", F.round(uniform([F.col("o_orderkey")], 123, "demo"), 9).alias("u"))


@query
def holdout_split(spark, sf):
    keys = views.table(spark, sf, "orders").select("o_orderkey")
    return explain.holdout_split(keys, "o_orderkey", 0.2, 42)


# -- participation and features ------------------------------------------------------


@query
def merge_projects(spark, sf):
    m = views.merged(spark, sf)
    return rounded(
        m.select(
            "projectID", "organisationID", "country", "ecContribution", "netEcContribution",
            "organisationTotalCost", "topics", "status", "projectTotalCost", "order",
        ),
        4,
    )


@query
def countries_per_project(spark, sf):
    return participation.countries_per_project(views.merged(spark, sf))


@query
def collab_flag(spark, sf):
    kept = views.relevant(spark, sf)
    flagged = participation.flagged_participations(views.organizations(spark, sf), kept, drop=("id",))
    return flagged.select("projectID", "organisationID", "order", "country", "is_collab")


@query
def member_filter(spark, sf):
    kept = features.keep_members(views.organizations(spark, sf), views.members(spark, sf))
    return kept.select("projectID", "organisationID", "order", "country")


@query
def country_totals(spark, sf):
    return rounded(features.group_totals(views.merged(spark, sf)))


@query
def country_ratios(spark, sf):
    return rounded(features.group_ratios(views.flagged(spark, sf)))


@query
def gdp_join(spark, sf):
    totals = features.group_totals(views.merged(spark, sf))
    number = F.regexp_extract("iso2", "[0-9]+", 0).cast("int") + 3
    shifted = views.gdp(spark, sf).withColumn("iso2", F.concat(F.lit("NATION_"), number))
    return rounded(features.join_denominator(totals, shifted))


@query
def participation_shares(spark, sf):
    totals = features.keep_members(features.group_totals(views.merged(spark, sf)), views.members(spark, sf))
    return rounded(features.participation_shares(stored(totals, "totals")))


def _features(spark, sf):
    return analysis.country_features(
        views.flagged(spark, sf), views.gdp(spark, sf), views.members(spark, sf), lambda df: stored(df, "base")
    )


def _scored(spark, sf):
    return stored(analysis.scored_countries(_features(spark, sf)), "scored")


def _weighted(spark, sf):
    return analysis.weighted_table(_scored(spark, sf))


@query
def country_features(spark, sf):
    return rounded(_features(spark, sf))


@query
def approx_unique_orgs(spark, sf):
    """Organisations per country from stored sketches, one per country and status, united on
    reading, beside the exact count and a sketch of the whole."""
    merged = views.merged(spark, sf).select("country", "status", "organisationID")
    slices = stored(distinct.value_sketches(merged, ["country", "status"], "organisationID"), "sketches")
    united = distinct.sketch_estimates(distinct.united_sketches(slices, ["country"]), "united")
    whole = distinct.united_sketches(distinct.value_sketches(merged, ["country"], "organisationID"), ["country"])
    exact = merged.groupBy("country").agg(F.countDistinct("organisationID").alias("unique_orgs"))
    joined = exact.join(united, "country").join(distinct.sketch_estimates(whole, "whole"), "country")
    error = F.abs(F.col("united") - F.col("unique_orgs"))
    return joined.select(
        "country", "unique_orgs", (error <= distinct.ERROR_BOUND * F.col("unique_orgs") + 0.5).alias("within_bound"),
        (F.col("united") == F.col("whole")).alias("slices_equal_whole"),
    )


@query
def bitmap_features(spark, sf):
    """All totals and ratios of each country, distinct counts by bitmaps."""
    return rounded(distinct.bitmap_features(views.flagged(spark, sf)))


@query
def bitmap_merge(spark, sf):
    """Distinct projects and organisations from stored bitmaps, one set per status, merged on reading."""
    ids = {"projectID": "total_projects", "organisationID": "unique_orgs"}
    slices = views.merged(spark, sf).withColumn("slice", F.concat_ws("/", "status", "country"))
    bitmaps = stored(distinct.id_bitmaps(slices, "slice", list(ids)), "bitmaps").withColumn("country", F.split_part("slice", F.lit("/"), F.lit(2)))
    return distinct.bitmap_counts(distinct.merged_bitmaps(bitmaps, "country"), "country", ids)


# -- scores --------------------------------------------------------------------------


@query
def minmax_scale(spark, sf):
    lines = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", F.lit(7.0).alias("flat")
    )
    scaled = scoring.minmax_scale(lines, ["l_extendedprice", "l_discount", "flat"])
    return rounded(scaled.drop("flat"))


@query
def row_mean_score(spark, sf):
    """Mean over metrics of which one is sometimes missing."""
    lines = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_discount", "l_tax", F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("quantity"),
    )
    return rounded(scoring.ensure_score(lines, ["l_discount", "l_tax", "quantity"]))


@query
def weighted_score(spark, sf):
    return rounded(_scored(spark, sf).select("country", "Score", "Weighted_Score"))


@query
def quintile_bins(spark, sf):
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return scoring.quantile_bins(orders, "o_totalprice")


@query
def quintile_labels(spark, sf):
    customers = views.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    binned = scoring.quantile_bins(customers, "c_acctbal")
    return scoring.bin_labels(binned, "bin", ["lowest", "low", "middle", "high", "highest"])


@query
def with_average_row(spark, sf):
    scored = _scored(spark, sf).select("country", "Weighted_Score", "total_projects")
    return rounded(scoring.with_average_row(scored))


@query
def score_ramp(spark, sf):
    return rounded(_weighted(spark, sf).select("country", "ramp", "is_average"))


@query
def country_scores(spark, sf):
    return rounded(analysis.country_scores(_weighted(spark, sf)))


@query
def ranked_contributions(spark, sf):
    names = views.shifted_names(spark, sf, 5)
    scores = _weighted(spark, sf).select("country", "Weighted_Score")
    return rounded(serving.ranked_contributions(scores, names))


# -- keyphrases ----------------------------------------------------------------------


def _texts(spark, sf):
    return keyphrases.one_text_per_key(views.texts(spark, sf), "doc_id", "text")


def _candidates(spark, sf):
    return keyphrases.candidate_phrases(_texts(spark, sf), "doc_id", "text", stop_words=views.STOP_WORDS)


def _scored_phrases(spark, sf, best=None):
    return keyphrases.text_relevance(_texts(spark, sf), "doc_id", "text", stop_words=views.STOP_WORDS, best=best)


def _topk(spark, sf, k=20):
    return keyphrases.phrase_topk(_scored_phrases(spark, sf, k), k, "doc_id")


@query
def unique_texts(spark, sf):
    """One text per source and language, of the many there are."""
    docs = views.table(spark, sf, "documents").withColumn("key", F.concat_ws("/", "source", "lang"))
    return keyphrases.unique_texts(docs, "key", "text")


@query
def unique_texts_by_position(spark, sf):
    """The first text of each source and language in the order of several files' rows."""
    path = scratch_path(spark, "positions")
    docs = views.table(spark, sf, "documents").withColumn("mark", F.md5(F.col("doc_id").cast("string")))
    write_artifact(docs.repartitionByRange(7, "mark").sortWithinPartitions("mark"), path)
    placed = with_position(read_table(spark, path)).withColumn("key", F.concat_ws("/", "source", "lang"))
    return keyphrases.unique_texts(placed, "key", "text", ["_position"])


@query
def candidate_phrases(spark, sf):
    return _candidates(spark, sf)


@query
def phrase_relevance(spark, sf):
    return _scored_phrases(spark, sf)


@query
def phrase_topk(spark, sf):
    return _topk(spark, sf).select("doc_id", "phrase", "score", "rank")


@query
def phrase_relevance_vectors(spark, sf):
    """The 20 phrases of each text that are nearest to it by word company."""
    scored = vectors.vector_relevance(_texts(spark, sf), "doc_id", "text", stop_words=views.STOP_WORDS, best=20)
    return keyphrases.phrase_topk(scored, 20, "doc_id").select("doc_id", "phrase", "tf", "score", "rank")


@query
def phrase_diversify(spark, sf):
    return keyphrases.phrase_diversify(_topk(spark, sf), 5, "doc_id")


@query
def phrase_stem_filter(spark, sf):
    return keyphrases.filter_phrases(_topk(spark, sf), views.STEMS).select("doc_id", "phrase", "rank")


@query
def project_keyphrases(spark, sf):
    kept = keyphrases.filter_phrases(_topk(spark, sf), views.STEMS)
    phrases = keyphrases.project_keyphrases(kept, "doc_id")
    return phrases.select("project_id", F.array_join("phrases", "; ").alias("phrases"))


@query
def keyphrase_extraction(spark, sf):
    """The whole text stage: 5 diverse phrases out of 20 per text, then the stem filter."""
    phrases = keyphrases.extract_keyphrases(
        views.texts(spark, sf), "doc_id", "text", stop_words=views.STOP_WORDS, stems=views.STEMS
    )
    return phrases.select("project_id", F.array_join("phrases", "; ").alias("phrases"))


def _terms(spark, sf):
    kept = keyphrases.filter_phrases(_topk(spark, sf), views.STEMS)
    return keyphrases.phrase_terms(keyphrases.project_keyphrases(kept, "doc_id"))


@query
def term_counts(spark, sf):
    return serving.term_counts(_terms(spark, sf))


@query
def top_terms(spark, sf):
    return serving.top_terms(serving.term_counts(_terms(spark, sf), ordered=False), 100)


@query
def text_clusters(spark, sf):
    found = clusters.text_clusters(views.texts(spark, sf), "doc_id", "text", views.STOP_WORDS)
    return found.select("doc_id", "cluster")


@query
def cluster_top_words(spark, sf):
    return clusters.cluster_top_words(
        clusters.text_clusters(views.texts(spark, sf), "doc_id", "text", views.STOP_WORDS)
    )


@query
def cluster_assignment(spark, sf):
    """Texts and the nearest of the sources' stored centres."""
    docs = views.table(spark, sf, "documents")
    clustered = docs.select("doc_id", F.col("source").alias("cluster"), tokens(F.col("text"), views.STOP_WORDS).alias("words"))
    idf, centres = clusters.stored_model(clustered, "doc_id")
    return clusters.assign_clusters(clustered, idf, centres, "doc_id")


@query
def source_top_words(spark, sf):
    """The top words of given groups: the documents' sources."""
    docs = views.table(spark, sf, "documents")
    words = docs.select(F.col("source").alias("cluster"), tokens(F.col("text"), views.STOP_WORDS).alias("words"))
    return clusters.cluster_top_words(words)


# -- explanation ---------------------------------------------------------------------


@query
def feature_importance(spark, sf):
    return explain.feature_importance(_scored(spark, sf), METRICS, "Score")


def _covariances(spark, sf):
    """A linear importance: each metric's absolute covariance with the score."""
    scored = _scored(spark, sf)
    covariances = [
        F.struct(F.lit(m).alias("feature"), F.abs(F.covar_pop(m + "_scaled", "Score")).alias("importance")) for m in METRICS
    ]
    return scored.agg(F.array(*covariances).alias("a")).select(F.inline("a"))


@query
def importance_percent(spark, sf):
    return rounded(serving.importance_percent(stored(_covariances(spark, sf), "importance")))


@query
def importance_training(spark, sf):
    """What the importance models are fitted on."""
    return rounded(explain.training_frame(_scored(spark, sf), METRICS, "Score"))


ORDER_METRICS = tuple(views.ORDER_WEIGHTS)


@query
def holdout_fit(spark, sf):
    """Both scores of the orders by boosted trees that the hold-out rows stop."""
    return rounded(models.fit_report(views.order_scores(spark, sf), features=ORDER_METRICS, key="order_id", trees=30, tolerance=0.03))


@query
def holdout_check(spark, sf):
    """What of the fits does not depend on the trees: the rows, the error of guessing the mean, and
    that the fits stopped before their limit and beat the guess."""
    report = models.fit_report(views.order_scores(spark, sf), features=ORDER_METRICS, key="order_id", trees=30, tolerance=0.03)
    return rounded(report.select(
        "label", "n_train", "n_test", "mean_error", (F.col("kept") < F.col("trees")).alias("stopped_early"),
        (F.col("holdout_error") < F.col("mean_error") / 2).alias("beats_mean"),
    ))


@query
def permutation_importance(spark, sf):
    """By how much the weighted score misses the equal-weight score more, over hold-out orders, when a
    metric is permuted."""
    scaled = {f"{m}_scaled": w for m, w in views.ORDER_WEIGHTS.items()}
    orders = explain.holdout_split(views.order_scores(spark, sf), "order_id").drop("Weighted_Score")
    found = models.permutation_importance(
        orders, lambda df: scoring.weighted_sum(df, scaled, "prediction"), tuple(scaled), "Score", "order_id"
    )
    return rounded(found, 9)


def _gaps(spark, sf):
    """Scores with one metric missing for the nations whose number ends in 3."""
    base = stored(analysis.base_features(views.flagged(spark, sf), views.gdp(spark, sf), views.members(spark, sf)), "base")
    base = base.withColumn("ec_per_gdp", F.when(~F.col("country").endswith("3"), F.col("ec_per_gdp")))
    scaled = scoring.minmax_scale(features.participation_shares(base), METRICS)
    return stored(analysis.scored_countries(scoring.row_mean(scaled, analysis.SCALED)), "gaps")


@query
def scores_with_gaps(spark, sf):
    """A missing metric through scaling, scores and the map: every row stays."""
    placed = explain.embedding_2d(_gaps(spark, sf))
    return rounded(placed.select("country", "Score", "Weighted_Score", F.col("x_2d").isNotNull().alias("is_placed")))


@query
def embedding_2d(spark, sf):
    return explain.embedding_2d(_scored(spark, sf)).select("country", "x_2d", "y_2d")


# -- projection ----------------------------------------------------------------------


def _paths(spark, sf, **kw):
    return projection.project_scores(_scored(spark, sf), views.pairs(spark, sf), **kw)


def _report(spark, sf):
    names = views.shifted_names(spark, sf, 5)
    return projection.projection_report(_paths(spark, sf), names=names, summaries=NOTES)


@query
def peer_lookup(spark, sf):
    return rounded(projection.peer_lookup(_scored(spark, sf), views.pairs(spark, sf)))


@query
def year_spine(spark, sf):
    return projection.year_spine(views.table(spark, sf, "supplier").select("s_suppkey"))


@query
def projection_glide(spark, sf):
    peers = projection.peer_lookup(_scored(spark, sf), views.pairs(spark, sf))
    glide = projection.with_glide(projection.year_spine(peers))
    return rounded(glide.select("country", "year", "progress", "glide"))


@query
def projection_current(spark, sf):
    return rounded(_paths(spark, sf, draws=3).select("country", "draw", "year", "score_current"))


@query
def projection_improved(spark, sf):
    return rounded(_paths(spark, sf, draws=3).select("country", "draw", "year", "score_improved"))


@query
def projection_many(spark, sf):
    """Every supplier as a country of its own: share of the best balance, catching up
    with the best of its nation."""
    suppliers = views.table(spark, sf, "supplier")
    scores = scoring.minmax_scale(suppliers, ["s_acctbal"]).select(
        F.col("s_suppkey").cast("string").alias("country"), F.col("s_acctbal_scaled").alias("Weighted_Score"), "s_nationkey"
    )
    best = scores.groupBy("s_nationkey").agg(F.max(F.struct("Weighted_Score", "country"))["country"].alias("peer"))
    pairs = scores.join(best, "s_nationkey").select("country", "peer")
    paths = projection.project_scores(scores, pairs)
    return rounded(paths.select("country", "peer", "year", "score_current", "score_improved"))


@query
def projection_explanation(spark, sf):
    return _report(spark, sf).select("country", "top_country", "explanation", "summary")


def _six_places(values: str):
    return F.array_join(F.transform(values, lambda x: F.format_string("%.6f", x)), ",")


@query
def projection_report(spark, sf):
    return _report(spark, sf).select(
        "country",
        F.array_join(F.col("years").cast("array<string>"), ",").alias("years"),
        _six_places("score_current").alias("score_current"),
        _six_places("score_improved").alias("score_improved"),
        "top_country",
        "summary",
    )


@query
def projection_series(spark, sf):
    series = projection.projection_series(_report(spark, sf))
    return rounded(series.select("country", "year", "score_current", "score_improved"))


@query
def projection_annotations(spark, sf):
    shocks = {**PROJECTION_SHOCKS, 2025: "First year", 2050: "Last year", 2060: "After the end"}
    return rounded(projection.projection_annotations(_report(spark, sf), shocks).drop("draw"))


# -- sources and sinks ---------------------------------------------------------------


@query
def csv_roundtrip(spark, sf):
    """Merged participations with their texts through CSV files; marker texts come back as NULL."""
    m = views.merged(spark, sf).select(
        "projectID", "organisationID", "order", "country", "ecContribution", "status", "topics",
        F.when(F.col("country") == "NATION_5", "NA").otherwise(F.col("country")).alias("code"),
        "objective",
    )
    path = scratch_path(spark, "csv")
    write_artifact(m, path, "csv")
    return mark_missing(read_table(spark, path, m.schema, "csv", multiline=True))


@query
def csv_single_file(spark, sf):
    """Texts with line breaks and quotes through one CSV file."""
    path = scratch_path(spark, "csv-file")
    docs = views.texts(spark, sf).withColumn("text", F.concat(F.lit('He said "a,b"\n\n'), "text"))
    write_single_file(docs, path, "csv")
    return read_table(spark, path, docs.schema, "csv", multiline=True)


@query
def json_single_document(spark, sf):
    """Documents as the records of one JSON list in one file, cut again by many tasks."""
    path = scratch_path(spark, "json-list")
    docs = views.table(spark, sf, "documents").select("doc_id", "text", "source")
    record = F.to_json(F.struct("doc_id", "text", F.struct("source").alias("of")))
    first = docs.agg(F.min("doc_id")).scalar()
    items = docs.select(F.col("doc_id").alias("at"), F.concat(F.when(F.col("doc_id") == first, "[").otherwise(", "), record).alias("value"))
    end = docs.agg((F.max("doc_id") + 1).alias("at")).select("at", F.lit("]").alias("value"))
    write_single_file(items.union(end).orderBy("at").select("value"), path, "text")
    read = read_json_shape(spark, path, "records", {"doc_id": "long", "text": "string", "of": "struct<source: string>"}, lines=False)
    return read.select("doc_id", "text", "of.source")


@query
def merge_projects_bucketed(spark, sf):
    """The merge of stored tables that lie in buckets by project: a join without a shuffle."""
    name = scratch_path(spark, "bucketed").rsplit("-", 1)[1]
    orgs = write_bucketed(views.organizations(spark, sf), f"orgs_{name}", scratch_path(spark, "orgs"), "projectID", 8)
    projects = write_bucketed(views.relevant(spark, sf), f"projects_{name}", scratch_path(spark, "projects"), "id", 8)
    m = participation.merge_participations(orgs, projects, drop=("id",))
    return rounded(m.select("projectID", "organisationID", "country", "order", "ecContribution", "topics", "status"), 4)


@query
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    write_artifact(_features(spark, sf), path)
    return rounded(read_table(spark, path))


@query
def json_artifact_roundtrip(spark, sf):
    """The scores a dashboard reads, through JSON lines."""
    path = scratch_path(spark, "json")
    write_artifact(analysis.country_scores(_weighted(spark, sf)), path, "json")
    return rounded(read_table(spark, path, schemas.COUNTRY_SCORES, "json"))


@query
def json_file_terms(spark, sf):
    """Documents as JSON objects in files of one per line, read back by shape."""
    path = scratch_path(spark, "json-files")
    docs = views.texts(spark, sf).select(
        F.to_json(F.create_map(F.col("doc_id").cast("string"), F.split("text", r"\. "))).alias("value")
    )
    docs.write.text(path)
    return read_json_shape(spark, path, "map")


@query
def keyphrases_artifact(spark, sf):
    """The keyphrases a dashboard reads, through JSON lines."""
    path = scratch_path(spark, "artifacts")
    kept = keyphrases.filter_phrases(_topk(spark, sf), views.STEMS)
    write_artifact(keyphrases.project_keyphrases(kept, "doc_id"), f"{path}/project_keyphrases", "json")
    return read_stage(spark, path, "project_keyphrases").withColumn("phrases", F.array_join("phrases", "; "))


@query
def projections_artifact(spark, sf):
    """The projections a dashboard reads, through JSON lines."""
    path = scratch_path(spark, "artifacts")
    write_artifact(_report(spark, sf), f"{path}/country_projections", "json")
    read = read_stage(spark, path, "country_projections")
    return read.select("country", _six_places("score_improved").alias("score_improved"), "top_country", "summary")


@query
def importance_artifact(spark, sf):
    """Importances by covariance, as a dashboard reads them, through JSON lines."""
    path = scratch_path(spark, "artifacts")
    write_artifact(_covariances(spark, sf), f"{path}/feature_importance", "json")
    return rounded(read_stage(spark, path, "feature_importance"))


@query
def raw_text_features(spark, sf):
    """From text columns end to end: projects, organisations and GDP written as CSV with
    European money, read with their schemas, then merged, flagged, parsed and aggregated."""
    path = scratch_path(spark, "raw")

    def money(col):
        """1.234,56 from a number."""
        english = F.format_number(F.col(col), 2)
        return F.translate(english, ",.", ".,")

    def as_csv(df, schema, name):
        have = set(df.columns)
        full = df.select(*[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ])
        write_artifact(full, f"{path}/{name}", "csv")
        return read_table(spark, f"{path}/{name}", schema, "csv", multiline=True)

    projects = views.projects(spark, sf).withColumn("totalCost", money("totalCost"))
    orgs = views.organizations(spark, sf)
    orgs = orgs.withColumns({c: money(c) for c in ("ecContribution", "netEcContribution", "totalCost")})
    balances = views.gdp(spark, sf).select(F.col("iso2").alias("Country Code"), F.col("2023").cast("decimal(20, 2)").cast("string").alias("2023"))
    merged = analysis.merge_stage(
        as_csv(projects, schemas.PROJECT, "project"), as_csv(orgs, schemas.ORGANIZATION, "organization"), views.PREFIXES, views.PATTERN
    )
    gdp = as_csv(balances, schemas.GDP, "gdp")
    codes = views.table(spark, sf, "nation").select(F.col("n_name").alias("iso3"), F.col("n_name").alias("iso2"))
    flagged = participation.parse_money(merged)  # read once, by one aggregation of a few of its columns
    ready = features.preprocess_gdp(gdp, codes)
    table = analysis.country_features(flagged, ready, views.members(spark, sf), lambda df: stored(df, "base"))
    return rounded(table)


@query
def json_records(spark, sf):
    """Each line item as a JSON list of two records."""
    record = lambda kind, col: F.struct(F.lit(kind).alias("kind"), F.col(col).alias("amount"))
    lines = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.to_json(F.array(record("price", "l_extendedprice"), record("quantity", "l_quantity"))).alias("doc"),
    )
    keep = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return records_from_json(lines, "doc", "kind: string, amount: double", keep)


@query
def json_columns(spark, sf):
    """Each line item as a JSON object of two equally long lists."""
    lines = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.to_json(
            F.struct(
                F.array(F.lit("discount"), F.lit("tax")).alias("feature"),
                F.array("l_discount", "l_tax").alias("importance"),
            )
        ).alias("doc"),
    )
    keep = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows_from_json_columns(lines, "doc", {"feature": "string", "importance": "double"}, keep)


@query
def json_map_explode(spark, sf):
    """Each document as a JSON object that maps its number to its list of sentences."""
    docs = views.texts(spark, sf).select(
        F.to_json(F.create_map(F.col("doc_id").cast("string"), F.split("text", r"\. "))).alias("doc")
    )
    return rows_from_json_map(docs, "doc")
