import pytest
from pyspark.sql import functions as F

from fundscape.operators import projection

SCORES = [("MT", 0.2), ("CY", 0.5), ("HR", 0.01), ("ES", 0.99), ("EU Average", 0.4)]


def scores(spark):
    return spark.createDataFrame(SCORES, "country string, Weighted_Score double")


def test_peer_target_and_missing(spark):
    got = {r["country"]: r for r in projection.peer_lookup(scores(spark)).collect()}
    assert got["MT"]["target_score"] == pytest.approx(0.2 + 0.95 * 0.3)
    with pytest.raises(Exception, match="no score for XX"):
        projection.peer_lookup(scores(spark), {"MT": "XX"}).collect()


def test_paths(spark):
    paths = projection.project_scores(scores(spark), draws=3)
    assert paths.count() == 2 * 3 * 26
    first = paths.filter("year = 2025").collect()
    low = dict(SCORES)
    assert all(r["score_current"] == r["score_improved"] == low[r["country"]] for r in first)
    for r in paths.collect():
        assert 0 <= r["score_current"] <= 1 and 0 <= r["score_improved"] <= 1
    last = {(r["country"], r["draw"]): r["score_improved"] for r in paths.filter("year = 2050").collect()}
    assert last["MT", 1] == pytest.approx(0.485)
    assert paths.filter("draw = 1").select("score_current").exceptAll(paths.filter("draw = 2").select("score_current")).count() > 0


def test_paths_do_not_depend_on_partitioning(spark):
    one = projection.project_scores(scores(spark).repartition(1))
    many = projection.project_scores(scores(spark).repartition(13))
    assert one.exceptAll(many).count() == 0


def test_walk_steps_and_shocks(spark):
    paths = projection.project_scores(scores(spark), {"MT": "CY"}, draws=400).cache()
    step = paths.filter("year IN (2025, 2026)").groupBy("draw").agg(
        F.max(F.when(F.col("year") == 2026, F.col("score_current"))).alias("b"),
        F.max(F.when(F.col("year") == 2025, F.col("score_current"))).alias("a"),
    )
    sd = step.agg(F.stddev(F.col("b") - F.col("a"))).first()[0]
    assert 0.008 < sd < 0.012
    glide = 0.2 + (2036 - 2025) / 25 * 0.285
    dip = paths.filter("year = 2036").agg(F.avg("score_improved")).first()[0] - glide
    assert -0.045 < dip < -0.035
    calm = paths.filter("year = 2037").agg(F.avg("score_improved")).first()[0] - (0.2 + 12 / 25 * 0.285)
    assert abs(calm) < 0.003
    paths.unpersist()


def test_one_year_horizon(spark):
    paths = projection.project_scores(scores(spark), n_years=1)
    assert [(r["score_current"], r["score_improved"]) for r in paths.filter("country = 'MT'").collect()] == [(0.2, 0.2)]


def test_report_series_annotations(spark):
    shocks = {2026: "First", 2027: "Second", 2090: "Outside"}
    paths = projection.project_scores(scores(spark), shocks=shocks, n_years=3)
    report = projection.projection_report(paths, shocks, {"MT": "Malta", "CY": "Cyprus"}).cache()
    row = report.filter("country = 'MT'").first()
    assert row["years"] == [2025, 2026, 2027] and row["top_country"] == "Cyprus"
    assert row["summary"].startswith("Malta's current climate engagement")
    assert "2026 – First, 2027 – Second, 2090 – Outside" in row["explanation"]
    assert row["explanation"].startswith("Malta is compared to Cyprus,") and "adopted 85% of Cyprus's" in row["explanation"]
    other = report.filter("country = 'HR'").first()
    assert other["top_country"] == "ES"
    series = projection.projection_series(report)
    assert series.columns == ["country", "draw", "year", "score_current", "score_improved"] and series.count() == 6
    notes = projection.projection_annotations(report, shocks).filter("country = 'MT'").orderBy("year").collect()
    height = max(row["score_current"] + row["score_improved"])
    assert [(r["year"], r["label"], r["height"]) for r in notes] == [(2026, "First", height), (2027, "Second", height)]
    none = projection.projection_report(paths, shocks, summaries={"ZZ": "x"})
    assert {r["summary"] for r in none.collect()} == {""}
    report.unpersist()
