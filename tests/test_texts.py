from collections import Counter
from itertools import combinations
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscape.operators import clusters, keyphrases, serving

STOP = ["the", "of", "and"]
TEXTS = [
    (3, "Carbon capture and carbon storage of the deep sea carbon capture"),
    (1, "Wind power of the sea. Wind power and carbon neutral wind farms by the sea coast with storage"),
    (2, "the of and"),
    (4, None),
    (10, "deep learning of wind"),
]


def texts(spark):
    return spark.createDataFrame(TEXTS, "projectID long, objective string")


def brute_candidates(text):
    words = [w.strip(".").lower() for w in text.split()]
    words = [w for w in words if w not in STOP]
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            p = " ".join(words[i : i + n])
            counts[p] = counts.get(p, 0) + 1
    return counts


def brute_keyphrases(rows, k, n, stems):
    cands = {key: brute_candidates(t) for key, t in rows if t is not None}
    df = {}
    for counts in cands.values():
        for p in counts:
            df[p] = df.get(p, 0) + 1
    out = {}
    for key, counts in cands.items():
        scored = {p: round(tf * log((len(cands) + 1) / (df[p] + 1)), 6) for p, tf in counts.items()}
        best = sorted(scored, key=lambda p: (-scored[p], p))[:k]

        def alike(choice):
            total = 0.0
            for a, b in combinations(choice, 2):
                x, y = set(a.split()), set(b.split())
                total += len(x & y) / len(x | y)
            return round(total, 9)

        chosen = min(combinations(best, n), key=alike) if len(best) > n else tuple(best)
        kept = [p for p in chosen if any(s in p for s in stems)]
        if kept:
            out[str(key)] = kept
    return out


def test_unique_texts_order_and_choice(spark):
    df = spark.createDataFrame([(10, "b"), (9, "x"), (10, "a"), (10, None), (2, None)], "projectID long, objective string")
    assert [tuple(r) for r in keyphrases.unique_texts(df).collect()] == [("9", "x"), ("10", "a")]


def test_candidates_and_frequencies(spark):
    df = keyphrases.one_text_per_key(texts(spark))
    got = {}
    for r in keyphrases.candidate_phrases(df, stop_words=STOP).collect():
        got.setdefault(r["projectID"], {})[r["phrase"]] = r["tf"]
    assert got == {k: brute_candidates(t) for k, t in TEXTS if t and brute_candidates(t)}
    freq = {r["phrase"]: r["df"] for r in keyphrases.phrase_frequencies(df, stop_words=STOP).collect()}
    assert freq["carbon"] == 2 and freq["wind"] == 2 and freq["carbon capture"] == 1


def test_hot_phrases_do_not_change_results(spark, monkeypatch):
    df = keyphrases.one_text_per_key(texts(spark))
    cands = keyphrases.candidate_phrases(df, stop_words=STOP)
    every = []
    for share in (0.0, 0.3, 1.0):
        monkeypatch.setattr(keyphrases, "HOT_SHARE", share)
        every.append(sorted(tuple(r) for r in keyphrases.phrase_relevance(cands, df).collect()))
    assert every[0] == every[1] == every[2]


def test_candidates_of_repeated_and_missing_keys(spark):
    rows = [(1, "wind wind sea"), (1, "sea wind"), (None, "deep sea"), (2, None)]
    df = spark.createDataFrame(rows, "projectID long, objective string")
    got = {(r["projectID"], r["phrase"]): r["tf"] for r in keyphrases.candidate_phrases(df, stop_words=STOP).collect()}
    one = {"wind": 3, "sea": 2, "wind wind": 1, "wind sea": 1, "wind wind sea": 1, "sea wind": 1}
    assert got == {(1, p): n for p, n in one.items()} | {(None, "deep"): 1, (None, "sea"): 1, (None, "deep sea"): 1}


def test_counting_holds_no_phrases_of_several_texts(spark):
    text = keyphrases.candidate_phrases(texts(spark), stop_words=STOP)._jdf.queryExecution().toString()
    assert "phrase" not in "".join(x for x in text.splitlines() if "Aggregate" in x or "Exchange" in x)


def test_text_relevance_is_that_of_the_candidates(spark, monkeypatch):
    words = [f"w{i * i % 7} w{i % 3} wé w{i % 5}" for i in range(40)]
    rows = [(i if i else None, " ".join(words[i : i + 1 + i % 9])) for i in range(40)] + [(90, ""), (91, "lone"), (92, "a of")]
    df = keyphrases.one_text_per_key(spark.createDataFrame(rows, "projectID long, objective string"))
    for share in (0.0, 0.3, 1.0):
        monkeypatch.setattr(keyphrases, "HOT_SHARE", share)
        for n in ((1, 3), (1, 1), (2, 2), (2, 4)):
            cands = keyphrases.candidate_phrases(df, n=n, stop_words=STOP)
            want = keyphrases.phrase_relevance(cands, df).select("projectID", "phrase", "tf", "df", "score")
            got = keyphrases.text_relevance(df, n=n, stop_words=STOP).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    best = keyphrases.text_relevance(df, stop_words=STOP, best=4)
    assert best.count() < keyphrases.text_relevance(df, stop_words=STOP).count()
    every = keyphrases.phrase_relevance(keyphrases.candidate_phrases(df, stop_words=STOP), df)
    tops = [sorted(map(str, keyphrases.phrase_topk(x, 4).select("projectID", "phrase", "tf", "df", "score", "rank").collect())) for x in (best, every)]
    assert tops[0] == tops[1]


def test_text_relevance_meets_by_ranges_of_names_not_by_place(spark, monkeypatch):
    monkeypatch.setattr(keyphrases, "SLICE", 7)
    monkeypatch.setattr(keyphrases, "RANGE", 5)
    rows = [(i if i else None, " ".join(f"w{(i * j) % 11}" for j in range(i % 8))) for i in range(30)] + [(40, ""), (41, None)]
    df = spark.createDataFrame(rows, "projectID long, objective string")
    want = keyphrases.phrase_relevance(keyphrases.candidate_phrases(df, stop_words=STOP), df)
    got = keyphrases.text_relevance(df, stop_words=STOP).select("projectID", "phrase", "tf", "df", "score")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    plan = got._jdf.queryExecution().toString()
    assert "Window" not in plan and "_range" in plan  # one row a slice and range of names, not one a place
    assert keyphrases.text_relevance(df.limit(0), stop_words=STOP, best=3).count() == 0


def test_names_of_phrases_travel_packed():
    import pyarrow as pa

    rnd = np.random.default_rng(3)
    texts = [[f"w{w}" for w in rnd.integers(0, 5000, 400)] for _ in range(100)]
    words = " ".join(w for ws in texts for w in ws).encode()
    columns = [pa.array([7]), pa.array([[400] * 100], pa.list_(pa.int32())), pa.array([len(words)]), pa.array([pa.compress(words, codec="zstd", asbytes=True)])]
    batch = pa.record_batch(columns, names=["_slice", "_sizes", "_length", "_w"])
    [blocks] = keyphrases._blocks(1, 3, 2)([batch])
    phrases = Counter(p for ws in texts for p in {" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)})
    sent = sum(len(x) for c in ("_names", "_more", "_counts") for x in blocks.column(c).to_pylist())
    assert sent < 9.5 * len(phrases)
    [sums] = [pa.concat_tables([keyphrases._summed(2)(pa.Table.from_batches([blocks.slice(i, 1)] * 3)).slice(0, 1) for i in range(blocks.num_rows)])]
    got = np.concatenate([keyphrases._large(x) for x in sums.column("_counts").to_pylist()])
    assert Counter(got.tolist()) == Counter(3 * n for n in phrases.values())


@pytest.mark.parametrize("numbers", [[], [0], [1, 255, 256], [2**64 - 1, 0, 5]])
def test_packed_numbers_come_back(numbers):
    assert keyphrases._large(keyphrases._small(np.array(numbers, np.uint64))).tolist() == numbers


def test_phrases_of_one_name_in_part_are_told_apart():
    names, more = np.array([7, 5, 7, 7, 5], np.uint64), np.array([1, 2, 0, 1, 2], np.uint32)
    order, of, starts = keyphrases._alike(names, more)
    assert [(names[i], more[i]) for i in order] == [(5, 2), (5, 2), (7, 0), (7, 1), (7, 1)]
    assert of.tolist() == [0, 0, 1, 2, 2] and starts.tolist() == [0, 2, 3]


def test_extraction_against_brute_force(spark):
    for k, n, stems in ((20, 5, ["carbon", "wind"]), (7, 3, ["sea", "deep"]), (4, 5, ["storage", "w"])):
        got = keyphrases.extract_keyphrases(texts(spark), stop_words=STOP, stems=stems, top_n=n, candidates=k)
        assert {r["project_id"]: r["phrases"] for r in got.collect()} == brute_keyphrases(TEXTS, k, n, stems)


def test_extraction_on_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang = 'en'")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    import re

    simple = [(k, " ".join(re.findall(r"\w{2,}", t.lower()))) for k, t in rows]
    df = spark.createDataFrame(simple, "projectID long, objective string")
    got = keyphrases.extract_keyphrases(df, stop_words=STOP, stems=["tion", "ment"])
    assert {r["project_id"]: r["phrases"] for r in got.collect()} == brute_keyphrases(simple, 20, 5, ["tion", "ment"])


def test_default_stop_words_and_stems(spark):
    got = keyphrases.extract_keyphrases(texts(spark)).collect()
    assert got and all(any("carbon" in p or "neutral" in p for p in r["phrases"]) for r in got)


def test_term_counts(spark):
    long = spark.createDataFrame([("1", ["a", "b"]), ("2", ["b"]), ("3", ["c"])], "project_id string, phrases array<string>")
    counts = serving.term_counts(keyphrases.phrase_terms(long))
    assert [tuple(r) for r in counts.collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [r["term"] for r in serving.top_terms(counts, 2).collect()] == ["b", "a"]


def test_clusters(spark):
    words = ["wind sea coast storm", "carbon capture storage plant"]
    df = spark.range(60).select(F.col("id").alias("projectID"), F.when(F.col("id") % 2 == 0, words[0]).otherwise(words[1]).alias("objective"))
    found = clusters.text_clusters(df, stop_words=STOP)
    by_text = found.groupBy("words").agg(F.countDistinct("cluster").alias("n"))
    assert found.count() == 60 and by_text.filter("n > 1").count() == 0
    top = clusters.cluster_top_words(found, 2)
    assert top.columns == ["topic", "word", "rank"] and top.filter("rank > 2").count() == 0
    assert clusters.text_clusters(df.limit(4), stop_words=STOP).count() == 0


def test_cluster_fit_holds_its_vectors_on_disk_only(spark, monkeypatch):
    held, fit = [], clusters.KMeans.fit

    def watched(self, vectors):
        held.append(vectors.storageLevel)
        return fit(self, vectors)

    monkeypatch.setattr(clusters.KMeans, "fit", watched)
    df = spark.range(30).select(F.col("id").alias("projectID"), F.concat_ws(" ", F.lit("wind sea"), F.col("id") % 3).alias("objective"))
    assert clusters.text_clusters(df, stop_words=STOP).count() == 30
    assert [(level.useDisk, level.useMemory) for level in held] == [(True, False)]
