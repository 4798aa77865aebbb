"""Fits steered by hold-out rows, permutation importance, ranks, vectors, sketches, bitmaps and stored clusters."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from fundscape.operators import clusters, distinct, explain, features, keyphrases, models, participation, vectors
from fundscape.operators.ranks import with_rank
from fundscape.plans import queries, views
from fundscape.session import scratch_path
from fundscape.sources import read_table, with_position, write_artifact, write_bucketed

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark):
    return views.order_scores(spark, SF)


# -- fits


def test_fit_is_stopped_by_the_holdout_rows_and_its_error_repeats_in_sql(spark, orders):
    for label in ("Score", "Weighted_Score"):
        fit = models.boosted_fit(orders, queries.ORDER_METRICS, label, "order_id", trees=40)
        report = models.fit_errors(fit.predictions).first().asDict()
        folder = scratch_path(spark, "kept-predictions")
        fit.predictions.write.parquet(folder)
        con = duckdb.connect()
        error, n = con.execute(f"SELECT sqrt(avg((label - prediction) ** 2)), count(*) FROM '{folder.removeprefix('file:')}/*.parquet' WHERE is_test").fetchone()
        assert report["holdout_error"] == pytest.approx(error) and report["n_test"] == n > 200
        assert fit.kept < fit.trees and report["holdout_error"] < report["mean_error"] / 2
        assert sum(fit.importance.values()) == pytest.approx(1)


def test_tables_without_holdout_or_training_rows(spark):
    few = spark.createDataFrame([(f"c{i}", float(i), float(i)) for i in range(4)], "country string, x double, Score double")
    fit = models.boosted_fit(few, ["x"], frac=0.0, trees=3)
    assert fit.kept == 3 and models.fit_errors(fit.predictions).first()["holdout_error"] is None
    with pytest.raises(ValueError):
        models.boosted_fit(few, ["x"], frac=1.0)
    gaps = few.withColumn("x", F.when(F.col("x") > 0, F.col("x")))
    assert models.boosted_fit(gaps, ["x"], frac=0.0, trees=2).predictions.count() == 3


# -- ranks and permutation importance


def test_ranks_are_those_of_one_sort(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(5), f"k{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "a int, k string")
    got = {r["k"]: r["rank"] for r in with_rank(df, ["a", "k"], partitions=7).collect()}
    assert got == {k: i for i, (_, k) in enumerate(sorted(rows))}
    assert "SinglePartition" not in plan(with_rank(df, ["a", "k"]))
    assert with_rank(df.limit(0), ["a", "k"]).count() == 0


def test_every_value_moves_to_another_row(spark):
    df = spark.createDataFrame([(f"c{i}", float(i), float(-i)) for i in range(50)], "country string, x double, y double")
    got = models.permuted_features(df, ["x", "y"], "country").collect()
    for name, sign in (("x", 1), ("y", -1)):
        moved = {r["country"]: r["value"] for r in got if r["feature"] == name}
        assert sorted(moved.values()) == sorted(float(sign * i) for i in range(50))
        assert all(moved[f"c{i}"] != sign * i for i in range(50))
    x, y = ({r["country"]: abs(r["value"]) for r in got if r["feature"] == n} for n in "xy")
    assert x != y


def test_permutation_importance_of_a_forest(spark):
    rnd = random.Random(2)
    rows = [(f"c{i}", rnd.random(), rnd.random(), rnd.random()) for i in range(400)]
    df = spark.createDataFrame([(*r, 3 * r[1] + r[2]) for r in rows], "country string, x double, y double, z double, Score double")
    split = explain.holdout_split(df, frac=0.3)
    assemble = VectorAssembler(inputCols=["x", "y", "z"], outputCol="_v")
    forest = RandomForestRegressor(featuresCol="_v", labelCol="Score", numTrees=20, seed=1, featureSubsetStrategy="all")
    model = forest.fit(assemble.transform(split.filter("NOT is_test")))
    found = models.permutation_importance(split, lambda t: model.transform(assemble.transform(t)), ["x", "y", "z"])
    by = {r["feature"]: r["importance"] for r in found.collect()}
    assert by["x"] > 5 * by["y"] > 0 and abs(by["z"]) < by["y"] / 5
    assert found.count() == 3 and "CartesianProduct" not in plan(found)


def test_permutation_importance_leaves_gaps_out(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 2.0), ("c", 3.0, 3.0)], "country string, x double, Score double").withColumn("is_test", F.lit(True))
    row = models.permutation_importance(df, lambda t: t.withColumn("prediction", F.col("x")), ["x"]).first()
    assert row["base_error"] == 0 and row["permuted_error"] == 4


# -- vectors


def brute_vectors(texts, dims=32, reach=2):
    import hashlib

    def code(w):
        m = hashlib.md5(w.encode()).hexdigest()
        return int(m[:8], 16) % dims, 1 if m[8] < "8" else -1

    company, own = defaultdict(lambda: [0] * dims), {}
    for d, ws in texts.items():
        own[d] = [0] * dims
        for i, w in enumerate(ws):
            p, s = code(w)
            own[d][p] += s
            for j in range(max(0, i - reach), min(len(ws), i + reach + 1)):
                if j != i:
                    p, s = code(ws[j])
                    company[w][p] += s
    out = {}
    for d, ws in texts.items():
        for n in (1, 2, 3):
            for i in range(len(ws) - n + 1):
                phrase = [x for w in ws[i : i + n] for x in company[w]]
                dot = sum(a * b for a, b in zip(phrase, own[d] * n, strict=True))
                size = math.sqrt(sum(a * a for a in phrase)) * math.sqrt(n * sum(b * b for b in own[d]))
                out[d, " ".join(ws[i : i + n])] = dot / size if size else 0.0
    return out


def test_vector_relevance_matches_brute_force(spark):
    rnd = random.Random(3)
    texts = {i: [rnd.choice("solar wind power grid storage heat pump cell".split()) for _ in range(rnd.randrange(1, 30))] for i in range(20)}
    rows = [(i, " ".join(ws)) for i, ws in texts.items()] + [(90, None), (91, ""), (92, "the of")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = vectors.vector_relevance(df, "doc_id", "text", stop_words=["the", "of"]).collect()
    want = brute_vectors(texts)
    assert {(r["doc_id"], r["phrase"]) for r in got} == set(want)
    assert all(abs(r["score"] - want[r["doc_id"], r["phrase"]]) < 2e-6 for r in got)
    tf = Counter((i, w) for i, ws in texts.items() for w in ws)
    assert all(r["tf"] == tf[r["doc_id"], r["phrase"]] for r in got if " " not in r["phrase"])


def test_vectors_are_added_up_by_slices_and_ranges(spark, monkeypatch):
    kept, store = {}, vectors.stored
    monkeypatch.setattr(vectors, "stored", lambda df, name, *more: kept.update({name: store(df, name, *more)}) or kept[name])
    monkeypatch.setattr(vectors, "SLICE", 50)
    monkeypatch.setattr(vectors, "RANGE", 4)
    rnd = random.Random(8)
    texts = {i: [rnd.choice([f"w{j}" for j in range(30)]) for _ in range(rnd.randrange(1, 25))] for i in range(40)}
    rows = [(i, " ".join(ws)) for i, ws in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    want = brute_vectors(texts)
    whole = {(r["doc_id"], r["phrase"]): r for r in vectors.vector_relevance(df, "doc_id", "text", stop_words=[]).collect()}
    assert set(whole) == set(want) and all(abs(r["score"] - want[k]) < 2e-6 for k, r in whole.items())
    assert list(kept) == ["slices"] and kept["slices"].count() <= sum(map(len, texts.values())) // 50 + 2  # not a row for each word
    best = vectors.vector_relevance(df, "doc_id", "text", stop_words=[], best=4)
    top = lambda found: {(r["doc_id"], r["rank"], r["phrase"], r["tf"], r["score"]) for r in keyphrases.phrase_topk(found, 4, "doc_id").collect()}
    assert top(best) == top(spark.createDataFrame(list(whole.values()))) and best.count() < len(whole)
    assert vectors.vector_relevance(df.limit(0), "doc_id", "text", stop_words=[]).count() == 0


def test_vectors_of_odd_keys_and_of_words_with_blanks(spark):
    df = spark.createDataFrame([(None, "sun wind"), ("a", "sun wind;sun;wind sun"), ("b", "sea")], "k string, t string")
    got = {(r["k"], r["phrase"]): r for r in vectors.vector_relevance(df, "k", "t", stop_words=[], n=(1, 2), pattern="[a-z ]+").collect()}
    assert set(got) == {("a", x) for x in ("sun wind", "sun", "wind sun", "sun wind sun")} | {("b", "sea")}
    assert got["a", "sun wind sun"]["tf"] == 2 and got["b", "sea"]["score"] == 0.0
    plain = vectors.vector_relevance(df, "k", "t", stop_words=[]).collect()
    assert {r["k"] for r in plain} == {"a", "b"}


def test_any_relevance_fits_into_the_extraction(spark):
    df = spark.createDataFrame([(1, "green hydrogen plant with green hydrogen growth"), (2, "solar plant growth")], "projectID long, objective string")
    scored = lambda texts: vectors.vector_relevance(texts, stop_words=["with"])
    got = {r["project_id"]: r["phrases"] for r in keyphrases.extract_keyphrases(df, stop_words=["with"], stems=("gr", "sol"), relevance=scored).collect()}
    assert set(got) == {"1", "2"} and all(1 <= len(p) <= 5 for p in got.values())


# -- first rows by position


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_first_row_in_file_order(spark, tmp_path, fmt):
    rnd = random.Random(4)
    rows = [(rnd.randrange(40), f"{rnd.random()}") for _ in range(2000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k int, t string")
    path = str(tmp_path / "t")
    write_artifact(df.repartitionByRange(5, "i").sortWithinPartitions("i"), path, fmt)
    want = {}
    for k, t in rows:
        want.setdefault(k, t)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2000", before):  # files in several ranges, ranges of several files
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            placed = with_position(read_table(spark, path, df.schema, fmt))
            got = keyphrases.one_text_per_key(placed, "k", "t", ["_position"])
            assert {r["k"]: r["t"] for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_row_agrees_with_file_row_numbers(spark, tmp_path):
    docs = views.table(spark, SF, "documents").withColumn("key", F.concat_ws("/", "source", "lang"))
    path = str(tmp_path / "t")
    write_artifact(docs.repartition(4), path)
    got = keyphrases.one_text_per_key(with_position(read_table(spark, path)), "key", "text", ["_position"]).collect()
    want = duckdb.connect().execute(
        f"SELECT key, arg_min(text, (filename, file_row_number)) FROM read_parquet('{path}/*.parquet', filename=true, file_row_number=true) WHERE text IS NOT NULL GROUP BY 1"
    ).fetchall()
    assert {tuple(r) for r in got} == set(want)


def test_first_text_needs_no_sort_by_text(spark):
    text = plan(keyphrases.one_text_per_key(views.texts(spark, SF), "doc_id", "text"))
    assert "Window" not in text and not any("Sort [" in x and "text" in x.split("Sort [")[1].split("]")[0] for x in text.splitlines())


# -- sketches and bitmaps


def test_sketches_unite_to_the_whole_within_the_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 7).alias("day"), F.pmod(F.xxhash64("id"), F.lit(15_000)).alias("v"))
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.countDistinct("v").alias("n")).collect()}
    united = distinct.united_sketches(distinct.value_sketches(df, ["g", "day"], "v"), ["g"])
    whole = distinct.united_sketches(distinct.value_sketches(df, ["g"], "v"), ["g"])
    a, b = ({r["g"]: r["estimate"] for r in distinct.sketch_estimates(x).collect()} for x in (united, whole))
    assert a == b and all(abs(a[g] - n) <= distinct.ERROR_BOUND * n for g, n in exact.items())
    nulls = spark.createDataFrame([(None, 1, 1), ("a", None, None)], "g string, day int, v int")
    assert distinct.value_sketches(nulls, ["g"], "v").count() == 0


def test_bitmap_features_equal_the_exact_ones_without_copies_of_rows(spark):
    rows = [("A", 1, 7, 10.0, "Signed", True), ("A", 1, 8, None, "closed", False), ("A", None, 40_000, 1.0, None, None), ("B", 100_000, None, 2.5, "TERMINATED", False), (None, 5, 5, 1.0, "x", True)]
    df = spark.createDataFrame(rows, "country string, projectID long, organisationID long, ecContribution double, status string, is_collab boolean")
    got, want = distinct.bitmap_features(df), features.group_features(df)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    assert "Expand" in plan(want) and "Expand" not in plan(got)


# -- storage for the join, stored clusters


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    orgs = write_bucketed(views.organizations(spark, SF), "t_orgs", str(tmp_path / "o"), "projectID", 4)
    projects = write_bucketed(views.relevant(spark, SF), "t_projects", str(tmp_path / "p"), "id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = participation.merge_participations(orgs, projects, drop=("id",))
        text = plan(merged)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert merged.count() == views.merged(spark, SF).count()
        assert "Exchange" not in plan(participation.countries_per_project(orgs))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_clusters_assign_as_the_fit_would(spark):
    rnd = random.Random(5)
    themes = ["solar cell panel light roof".split(), "wind blade tower turbine sea".split(), "heat pump boiler house water".split()]
    rows = [(i, " ".join(rnd.choice(themes[i % 3]) for _ in range(30))) for i in range(90)]
    found = clusters.text_clusters(spark.createDataFrame(rows, "projectID long, objective string"), stop_words=[])
    idf, centres = clusters.stored_model(found)
    got = {r["projectID"]: r for r in clusters.assign_clusters(found, idf, centres).collect()}
    assert {i: r["cluster"] for i, r in got.items()} == {r["projectID"]: r["cluster"] for r in found.collect()}
    w, c = {r["word"]: r["idf"] for r in idf.collect()}, defaultdict(dict)
    for r in centres.collect():
        c[r["cluster"]][r["word"]] = r["weight"]
    for i, text in rows:
        x = {t: n * w[t] for t, n in Counter(text.split()).items()}
        ways = {k: sum((x.get(t, 0) - v.get(t, 0)) ** 2 for t in {*x, *v}) for k, v in c.items()}
        assert got[i]["distance"] == min(ways.values()) / 1e6
    nearer = sum(r["distance"] for r in got.values())
    shuffled = clusters.stored_model(found.withColumn("cluster", F.col("projectID") % 2))
    assert nearer < sum(r["distance"] for r in clusters.assign_clusters(found, *shuffled).collect())


def test_slices_of_texts_meet_words_once_and_keep_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(clusters, "SLICE", 9)
    rnd = random.Random(3)
    rows = [(i // 2 if i % 7 else None, [rnd.choice("abcdefgh") + "x" * (i % 3) for _ in range(i % 6)] + [None] * (i % 2), rnd.choice("PQR")) for i in range(40)]
    found = spark.createDataFrame([*rows, (50, None, "P"), (50, None, None)], "projectID long, words array<string>, cluster string")
    idf, centres = clusters.stored_model(found)
    n, df, tf, size = found.count(), Counter(), Counter(), Counter(r["cluster"] for r in found.collect())
    for k, c in {(k, c) for k, _, c in rows}:
        df.update({w for a, words, b in rows if (a, b) == (k, c) for w in words if w})
    for _, words, c in rows:
        tf.update((c, w) for w in words if w)
    w = {word: round(1000 * math.log((n + 1) / (d + 1))) for word, d in df.items()}
    assert {r["word"]: r["idf"] for r in idf.collect() if r["word"]} == w
    centre = {(r["cluster"], r["word"]): r["weight"] for r in centres.collect()}
    assert centre == {(c, word): math.floor(t * w[word] / size[c] + 0.5) for (c, word), t in tf.items()}
    got = sorted(map(str, (tuple(r) for r in clusters.assign_clusters(found, idf, centres).collect())))
    want = []
    for k, _, _ in [*rows, (50, None, None), (50, None, None)]:
        x = Counter(word for a, words, _ in rows if a == k is not None for word in words if word)
        ways = [(sum((x[t] * w[t] - centre.get((c, t), 0)) ** 2 for t in w), c) for c in "PQR"]
        want.append(str((k, min(ways)[1], min(ways)[0] / 1e6)))
    assert got == sorted(want)
    asked = clusters.assign_clusters(found, idf, centres)._jdf.queryExecution().toString()
    assert "posexplode" in asked and "FlatMapCoGroupsInArrow" in asked


def test_texts_without_known_words(spark):
    found = spark.createDataFrame([(1, ["a", "b"], 0), (2, ["c"], 1)], "projectID long, words array<string>, cluster int")
    idf, centres = clusters.stored_model(found)
    new = spark.createDataFrame([(3, ["new"]), (4, None), (5, []), (6, ["c", "new"])], "projectID long, words array<string>")
    got = {r["projectID"]: (r["cluster"], r["distance"]) for r in clusters.assign_clusters(new, idf, centres).collect()}
    assert got[3] == got[4] == got[5] == (1, (1000 * math.log(1.5) // 1) ** 2 / 1e6) and got[6] == (1, 0.0)
