"""The pipeline's stages, each on what the one before kept, against brute force."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from fundscape.llm import language_id, mixing, token_store
from tests.llm.helpers import jaccard_classes, leaks
from tests.llm.test_table_operators import brute_tokens, water_filled

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    junk = spark.createDataFrame([(90_001, "123 ???", "en", "src0", 7), (90_002, None, None, None, None)], docs.schema)
    table, kept = docs.union(junk), {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in table.select("doc_id", "text").collect()]
        out = stage(spark, table, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "token_output":
            assert after.columns == corpus_pipeline.COLUMNS
        ids = Counter(r[0] for r in after.select("doc_id").collect())
        if name == "language_id":
            assert ids == Counter(d for d, t in before if any(c.isalpha() for c in t or ""))
        elif name == "ngram_jaccard_join":
            assert ids == Counter(d for d, c, _ in jaccard_classes(before) if d == c)
        elif name == "benchmark_decontamination":
            assert ids == Counter({d: 1 for d, (_, hit, _) in leaks(before, bench).items() if not hit})
        elif name == "source_mixing":
            mixed = mixing.mix(table).select("doc_id", "source", "size", "copies").collect()
            assert ids == Counter({r[0]: r[3] for r in mixed if r[3]})
            sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
            for _, s, n, c in mixed:
                sizes[s], taken[s], longest[s] = sizes[s] + n, taken[s] + n * c, max(longest[s], n)
            assert all(abs(taken[s] - t) <= longest[s] for s, t in water_filled(sizes).items())
        else:
            got = [tuple(r) for r in after.select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
            assert sorted(got) == sorted((d, *x) for d, xs in brute_tokens(before, 2).items() for x in xs)
        kept[name], table = ids, after
    assert all(sum(n.values()) > 50 for n in kept.values()) and token_store.tokenizer_path()


def test_decoder_decides(spark):
    """Texts that the decoder cannot place go, all labelled documents stay."""
    docs, rnd = spark.read.parquet(f"{SF}/documents.parquet"), random.Random(0)
    strange = [" ".join("".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(rnd.randrange(1, 8))) for _ in range(30)) for _ in range(200)]
    junk = spark.createDataFrame([(90_000 + i, t, None, "src0", len(t)) for i, t in enumerate(strange)], docs.schema)
    kept = {r[0] for r in corpus_pipeline.identify_language(spark, docs.union(junk), SF).select("doc_id").collect()}
    model = language_id.fit(docs.filter(~language_id.held_out()))
    gone = {90_000 + i for i, (_, score, _) in enumerate(model.predict(strange)) if score < 0.45}
    assert len(gone) > 5 and not kept & gone
    assert kept == {r[0] for r in docs.select("doc_id").collect()} | set(range(90_000, 90_200)) - gone


def test_no_language_to_learn(spark):
    texts = ["some words", "1 2 3", "", None, "\U00010400", "\u0444"]
    docs = spark.createDataFrame([(i, t, None, "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [0, 4, 5]


def test_stages_take_empty_tables_and_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = docs.withColumns({"a.b": docs.doc_id, "language": docs.lang, "u": docs.source, "Key": docs.text, "_0": docs.n_chars})
    for k, table in enumerate((odd, odd.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            before = table.columns
            stage(spark, table, SF).write.parquet(f"{tmp_path}/{k}-{name}")
            table = spark.read.parquet(f"{tmp_path}/{k}-{name}")
            assert table.columns == before or name == "token_output"
        assert (table.count() > 0) == (not k)
