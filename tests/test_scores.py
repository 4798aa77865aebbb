import math

import pytest
from pyspark.sql import functions as F

from fundscape.constants import EU_MEMBERS, METRICS, SCORE_WEIGHTS
from fundscape.operators import explain, features, participation, relevance, scoring, serving
from fundscape.operators.quantiles import exact_quantiles
from fundscape.plans import analysis


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_relevance_union_is_one_filter(spark):
    data = [
        (1, "HORIZON-CL5-x", None),
        (2, "HORIZON-CL6-x", "CO2."),
        (3, "HORIZON-CL4-x", "CO2eq"),
        (4, None, "net-zero"),
        (5, None, None),
        (6, "HORIZON-CL4-y", "about Circular Economy"),
    ]
    df = spark.createDataFrame(data, "id long, topics string, objective string")
    assert [r["id"] for r in relevance.select_relevant(df).orderBy("id").collect()] == [1, 2, 4, 6]


def test_merge_suffixes_drop_rename(spark):
    orgs = spark.createDataFrame(
        [(1, 10, "MT", "5", "7", "r1"), (1, 11, "CY", "6", "8", "r2"), (9, 12, "CY", "6", "8", "r3")],
        "projectID long, organisationID long, country string, ecContribution string, totalCost string, rcn string",
    )
    projects = spark.createDataFrame([(1, "SIGNED", "100", "r", "T")], "id long, status string, totalCost string, rcn string, title string")
    merged = participation.merge_participations(orgs, projects)
    assert merged.columns == [
        "projectID", "organisationID", "country", "ecContribution", "organisationTotalCost",
        "status", "projectTotalCost", "projectTitle",
    ]
    assert merged.count() == 2
    twice = participation.merge_participations(orgs, projects.union(projects))
    assert twice.count() == 4


PARTS = [
    (1, 10, "MT", "1.000,00", "signed"),
    (1, 11, "XX", "2.000,00", "Signed"),
    (2, 10, "MT", "500", "CLOSED"),
    (2, 10, "MT", None, None),
    (3, 12, "GR", "bad", "TERMINATED"),
    (3, 13, None, "9", "TERMINATED"),
    (4, 14, "EL", "7", "closed"),
]
PARTS_SCHEMA = "projectID long, organisationID long, country string, ecContribution string, status string"


def test_collaboration_counts_all_countries(spark):
    df = spark.createDataFrame(PARTS, PARTS_SCHEMA)
    counts = dict(rows(participation.countries_per_project(df), "projectID"))
    assert counts == {1: 2, 2: 1, 3: 1, 4: 1}
    flagged = participation.collab_flag(df)
    assert flagged.count() == len(PARTS)
    assert {r["projectID"] for r in flagged.filter("is_collab").collect()} == {1}


def test_group_features(spark):
    df = participation.collab_flag(participation.parse_money(spark.createDataFrame(PARTS, PARTS_SCHEMA)))
    got = {r["country"]: r for r in features.group_features(df).collect()}
    assert set(got) == {"MT", "XX", "GR", "EL"}
    mt = got["MT"]
    assert (mt["total_ec_contribution"], mt["total_projects"], mt["unique_orgs"]) == (1500.0, 2, 1)
    assert mt["collab_project_ratio"] == pytest.approx(1 / 3)
    assert (mt["signed_pct"], mt["closed_pct"], mt["terminated_pct"]) == pytest.approx((1 / 3, 1 / 3, 0))
    assert got["GR"]["total_ec_contribution"] == 0.0 and got["GR"]["success_ratio"] == -1.0
    kept = features.keep_members(features.group_features(df), EU_MEMBERS)
    assert {r["country"] for r in kept.collect()} == {"MT", "GR"}


def test_flagged_plan_equals_two_steps(spark):
    orgs = spark.createDataFrame([(p, o, c) for p, o, c, *_ in PARTS], "projectID long, organisationID long, country string")
    projects = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c2")], "id long, status string")
    one = participation.flagged_participations(orgs, projects)
    two = participation.collab_flag(participation.merge_participations(orgs, projects)).select(*one.columns)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_denominator_zero_and_missing(spark):
    f = spark.createDataFrame([("A", 10.0), ("B", 10.0), ("C", 10.0)], "country string, total_ec_contribution double")
    d = spark.createDataFrame([("A", 4.0), ("B", 0.0), (None, 3.0)], "iso2 string, `2023` double")
    got = rows(features.join_denominator(f, d), "country")
    assert got == [("A", 10.0, 4.0, 2.5), ("B", 10.0, 0.0, 0.0), ("C", 10.0, 0.0, 0.0)]


def test_gdp_codes(spark):
    from fundscape.sources import iso_codes

    gdp = spark.createDataFrame(
        [("Malta", "MLT", "10"), ("Arab World", "ARB", "5"), ("Samoa", "ASM", None)],
        "`Country Name` string, `Country Code` string, `2023` string",
    )
    codes = iso_codes(spark)
    got = features.preprocess_gdp(gdp, codes).select("Country Code", "iso2", "2023")
    assert rows(got, "Country Code") == [("ARB", None, 5.0), ("ASM", "AS", None), ("MLT", "MT", 10.0)]
    assert codes.count() >= 249 and codes.filter(F.col("iso2").isin(*EU_MEMBERS)).count() == 27


def test_alias_codes(spark):
    df = spark.createDataFrame([("EL", 1), ("MT", 2), (None, 3)], "country string, n int")
    assert rows(features.alias_codes(df, {"EL": "GR"}), "n") == [("GR", 1), ("MT", 2), (None, 3)]


def test_shares_and_zero_totals(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 3.0)], "k string, v double")
    assert rows(features.share_of_total(df, "v", "s"), "k") == [("A", 1.0, 0.25), ("B", 3.0, 0.75)]
    assert rows(features.ratio_to_max(df, "v", "s"), "k") == [("A", 1.0, 1 / 3), ("B", 3.0, 1.0)]
    zero = spark.createDataFrame([("A", 0.0)], "k string, v double")
    assert rows(features.share_of_total(zero, "v", "s"), "k") == [("A", 0.0, None)]


def test_minmax_constant_null_single(spark):
    df = spark.createDataFrame([("A", 1.0, 5.0, None), ("B", 3.0, 5.0, 2.0), ("C", None, 5.0, 4.0)], "k string, x double, c double, n double")
    got = rows(scoring.minmax_scale(df, ["x", "c", "n"]).select("k", "x_scaled", "c_scaled", "n_scaled"), "k")
    assert got == [("A", 0.0, 0.0, None), ("B", 1.0, 0.0, 0.0), ("C", None, 0.0, 1.0)]
    one = scoring.minmax_scale(df.limit(1), ["c"])
    assert one.first()["c_scaled"] == 0.0


def test_row_mean_and_weighted_sum(spark):
    df = spark.createDataFrame([("A", 1.0, None), ("B", None, None), ("C", 1.0, 3.0)], "k string, x double, y double")
    assert rows(scoring.row_mean(df, ["x", "y"], "m").select("k", "m"), "k") == [("A", 1.0), ("B", None), ("C", 2.0)]
    weighted = scoring.weighted_sum(df, {"x": 0.5, "y": 0.25}, "w").select("k", "w")
    assert rows(weighted, "k") == [("A", None), ("B", None), ("C", 1.25)]
    present = df.withColumn("Score", F.lit(9.0))
    assert scoring.ensure_score(present, ["x"]).first()["Score"] == 9.0


VALUES = [0.1, 0.4, 0.45, 0.9, 0.2, 0.33, 0.8]


def test_quintiles(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v double")
    assert [r["bin"] for r in scoring.quantile_bins(df, "v").orderBy("i").collect()] == [0, 2, 3, 4, 0, 1, 4]
    labelled = scoring.bin_labels(scoring.quantile_bins(df, "v"), "bin", list("abcde"))
    assert [r["label"] for r in labelled.orderBy("i").collect()] == list("acdeabe")
    flat = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "v double")
    with pytest.raises(ValueError, match="differ"):
        scoring.quantile_bins(flat, "v")


@pytest.mark.parametrize("kind", ["smooth", "hot", "few"])
def test_quantiles_by_ranges_equal_percentile(spark, kind):
    n = 5000
    expr = {
        "smooth": "cast(pmod(hash(id), 100003) as double)",
        "hot": "case when id % 3 = 0 then 7.0D else cast(pmod(hash(id), 50) as double) end",
        "few": "cast(id % 4 as double)",
    }[kind]
    df = spark.range(n).selectExpr(f"{expr} as v")
    probs = [0.0, 0.1, 0.2, 1 / 3, 0.5, 0.77, 0.999, 1.0]
    want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert exact_quantiles(df, "v", probs, few=20, accuracy=50) == pytest.approx(want, abs=1e-9)
    assert exact_quantiles(df.repartition(13), "v", probs, few=20, accuracy=50) == pytest.approx(want, abs=1e-9)


def test_quantiles_of_ten_times_as_many_values(spark):
    for n in (20_000, 200_000):
        df = spark.range(n).selectExpr("cast(pmod(hash(id), 1000003) as double) as v")
        probs = [0.2, 0.4, 0.6, 0.8]
        want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
        assert exact_quantiles(df, "v", probs, few=500, accuracy=1000) == pytest.approx(want, abs=1e-9)


def test_map_keeps_every_row(spark):
    data = [(f"c{i}", float(i), float(i * i % 7), None if i == 3 else float(i % 3)) for i in range(10)]
    df = spark.createDataFrame(data, "country string, a double, b double, c double")
    got = {r["country"]: (r["x_2d"], r["y_2d"]) for r in explain.embedding_2d(df, ["a", "b", "c"]).collect()}
    assert len(got) == 10 and got["c3"] == (None, None) and all(None not in v for k, v in got.items() if k != "c3")
    empty = explain.embedding_2d(df.withColumn("b", F.lit(None).cast("double")), ["a", "b", "c"])
    assert empty.count() == 10 and empty.filter("x_2d IS NULL").count() == 1
    nothing = explain.embedding_2d(df.withColumn("a", F.lit(None).cast("double")), ["a"])
    assert nothing.filter("x_2d IS NULL").count() == 10


def test_importance_names_missing_values(spark):
    data = [(f"c{i}", float(i), None if i % 4 == 3 else float(i % 3), float(i)) for i in range(30)]
    df = spark.createDataFrame(data, "country string, a double, b double, Score double")
    with pytest.raises(ValueError, match="b"):
        explain.feature_importance(df, ["a", "b"], trees=3)
    got = explain.feature_importance(df, ["a", "b"], trees=3, drop_incomplete=True).collect()
    assert sum(r["importance"] for r in got) == pytest.approx(1) and all(r["importance"] >= 0 for r in got)


def test_average_row_and_ramp(spark):
    df = spark.createDataFrame([("A", 1.0, 5), ("B", 3.0, 6), ("C", 2.5, 7)], "country string, Weighted_Score double, other int")
    table = scoring.ramp_position(scoring.with_average_row(df))
    got = {r["country"]: (r["Weighted_Score"], r["other"], r["ramp"], r["is_average"]) for r in table.collect()}
    assert got["EU Average"] == (pytest.approx(6.5 / 3), None, None, True)
    assert got["A"] == (1.0, 5, 0.0, False) and got["B"] == (3.0, 6, 1.0, False) and got["C"][2] == 0.75
    flat = scoring.ramp_position(df.filter("country = 'A'"))
    assert flat.first()["ramp"] == 0.0


def test_order_and_top_k(spark):
    df = spark.createDataFrame([("B", 1.0), ("A", 1.0), ("C", None), ("D", 2.0)], "country string, Weighted_Score double")
    ranked = [r["full_name"] for r in serving.ranked_contributions(df, {"A": "Alpha"}).collect()]
    assert ranked == ["D", "Alpha", "B", "C"]
    assert [r["country"] for r in scoring.top_k(df, "Weighted_Score", 2, "country").collect()] == ["D", "A"]


def scored_countries(spark, n=12):
    base = spark.range(n).select(
        F.concat(F.lit("C"), F.col("id")).alias("country"),
        *[((F.col("id") * (i + 3)) % (7 + i)).cast("double").alias(m) for i, m in enumerate(METRICS)],
    )
    return scoring.weighted_sum(scoring.row_mean(scoring.minmax_scale(base, METRICS), list(SCORE_WEIGHTS)))


def test_scores_lie_in_unit_range_under_any_partitioning(spark):
    df = scored_countries(spark)
    one, many = (rows(scored_countries(spark).repartition(p), "country") for p in (1, 13))
    assert one == many
    for r in df.collect():
        assert 0 <= r["Score"] <= 1 and 0 <= r["Weighted_Score"] <= 1


def test_importance_and_percent(spark):
    imp = explain.feature_importance(scored_countries(spark, 40), seed=0, trees=20)
    got = [r["importance"] for r in imp.collect()]
    assert len(got) == 6 and min(got) >= 0 and math.isclose(sum(got), 1, abs_tol=1e-9)
    percent = serving.importance_percent(imp).agg(F.sum("percent")).first()[0]
    assert percent == pytest.approx(100)


def test_embedding_and_holdout(spark):
    df = scored_countries(spark, 20)
    points = explain.embedding_2d(df)
    var = points.agg(F.variance("x_2d"), F.variance("y_2d"), F.corr("x_2d", "y_2d")).first()
    assert var[0] >= var[1] > 0 and abs(var[2]) < 1e-6
    keys = spark.range(5000).select(F.col("id").cast("string").alias("country"))
    share = explain.holdout_split(keys).filter("is_test").count() / 5000
    assert 0.17 < share < 0.23


def test_country_features_shares_are_over_members(spark):
    parts = participation.parse_money(spark.createDataFrame(PARTS, PARTS_SCHEMA))
    gdp = spark.createDataFrame([("MT", 100.0), ("GR", 50.0)], "iso2 string, `2023` double")
    got = {r["country"]: r for r in analysis.country_features(participation.collab_flag(parts), gdp).collect()}
    assert set(got) == {"MT", "GR"}
    assert got["MT"]["funding_share"] == 1.0 and got["GR"]["project_share"] == 0.5
    assert got["MT"]["collab_project_ratio"] == pytest.approx(1 / 3)
    assert sum(r["funding_share"] for r in got.values()) == pytest.approx(1)


def test_nan_has_no_bin(spark):
    rows = [(i, float(i)) for i in range(50)] + [(90 + i, float("nan")) for i in range(3)] + [(99, None)]
    df = spark.createDataFrame(rows, "k int, x double")
    got = {r["k"]: r["bin"] for r in scoring.quantile_bins(df, "x").collect()}
    assert [got[i] for i in (0, 10, 20, 49)] == [0, 1, 2, 4] and {got[k] for k in (90, 91, 92, 99)} == {None}
