"""Language ID, quality, secrets, decontamination and the Jaccard join."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscape.llm import decontamination, jaccard_join, language_id, quality, secret_scan
from tests.llm.helpers import AWKWARD, BASE, awkward, empty, jaccard_classes, leaks, row, SCHEMA

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# -- decontamination


def test_leaks_match_brute_force(spark):
    words = "aa bb cc dd".split()
    rnd = random.Random(1)
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 60)))) for i in range(60)] + [(60, None), (61, "Aa-BB")]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate((12, 11, 3, 2, 25, 10, 0))] + [(7, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in rows(decontamination.find_leaks(d, b), "doc_id", "leak.n_words", "leak.n_hit", "leak.items")}
    assert got == leaks(docs, items)


def test_leaks_over_several_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 40)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 2000)
    docs, bench = read(spark, "documents"), read(spark, "benchmark")
    got = {r[0]: tuple(r[1:]) for r in rows(decontamination.find_leaks(docs, bench), "doc_id", "leak.n_words", "leak.n_hit", "leak.items")}
    assert got == leaks(rows(docs, "doc_id", "text"), rows(bench, "item_id", "text"))
    assert any(n for _, n, _ in got.values())


def test_leaks_awkward_tables(spark):
    bench = read(spark, "benchmark")
    found = decontamination.find_leaks(awkward(spark).withColumnRenamed("h", "leak"), bench)
    assert found.columns[-1] == "leak_" and found.count() == len(AWKWARD)
    assert decontamination.find_leaks(empty(spark), bench).count() == 0
    none = decontamination.find_leaks(awkward(spark), bench.limit(0))
    assert {r[0] for r in rows(none, "leak.n_hit")} == {0}
    same_id = spark.createDataFrame([(None, "One two three"), (1, "one two three")], "item_id long, text string")
    assert decontamination.remove_leaks(awkward(spark), same_id).count() == len(AWKWARD) - 3


def test_longest_matches(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"start {text} end"), (2, " ".join(text.split()[5:30]))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, f"other {text} stop")], "item_id long, text string")
    got = {r[1]: r for r in rows(decontamination.longest_matches(docs, bench), "item", "item_at", "length", "doc", "doc_at")}
    assert got[1] == ("7", 1, 40, 1, 1) and got[10] == ("7", 10, 31, 1, 10) and max(got) == 31


@pytest.mark.parametrize(("block_words", "shard_bytes"), [(200_000, 16 << 20), (30, 300)])
def test_matches_are_the_longest(spark, monkeypatch, block_words, shard_bytes):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard_bytes)
    rnd = random.Random(5)
    docs = {i: [rnd.choice("abc") for _ in range(rnd.randrange(0, 80))] for i in range(40)}
    items = {i: [rnd.choice("abcd") for _ in range(n)] for i, n in enumerate((30, 14, 5, 6, 1, 45))}
    items[6] = docs[3][2:40]
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r[0], r[1]): r[2:] for r in rows(decontamination.longest_matches(d, b, least=4), "item", "item_at", "length", "doc", "doc_at")}
    want = {}
    for i, w in items.items():
        for a in range(len(w)):
            shared = max((n for x in docs.values() for p in range(len(x)) for n in range(len(w) - a + 1) if x[p : p + n] == w[a : a + n]), default=0)
            if shared >= 4:
                want[str(i), a] = shared
    assert {k: v[0] for k, v in got.items()} == want and want
    for (i, a), (n, doc, at) in got.items():
        assert docs[doc][at : at + n] == items[int(i)][a : a + n]


def test_leaks_among_many_other_words(spark):
    rnd = random.Random(8)
    passage = lambda: [rnd.choice("abcd") for _ in range(12)]
    items = [(i, " ".join(passage())) for i in range(30)]
    docs = []
    for i in range(60):
        other = [f"w{rnd.randrange(100_000)}" for _ in range(300)]
        inside = items[i % 30][1].split() if i % 4 == 0 else passage()
        docs.append((i, " ".join(other[:150] + inside + other[150:])))
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in rows(decontamination.find_leaks(d, b), "doc_id", "leak.n_words", "leak.n_hit", "leak.items")}
    assert got == leaks(docs, items) and sum(n > 0 for _, n, _ in got.values()) == 15


def test_one_array_serves_all_blocks(spark, monkeypatch):
    blocks = decontamination.write_blocks(read(spark, "benchmark"), decontamination.shared_dir(spark, "blocks"), "item_id", "text")
    text = " ".join(r[0] or "" for r in rows(read(spark, "benchmark").limit(5), "text"))
    built = []
    array = decontamination.Suffixes
    monkeypatch.setattr(decontamination, "Suffixes", lambda *a: built.append(a) or array(*a))
    many = decontamination.search_shard([text], blocks * 3, 10, {})
    assert len(built) == 1 and many[0][1] > 0


def test_long_texts_are_weighed_in_slices(monkeypatch):
    rng = np.random.default_rng(3)
    model = language_id.Model(["a", "b", "c"], language_id.codewords(3), rng.normal(size=(1 << language_id.BUCKET_BITS, 3)).astype(np.float32), np.ones((2, 3)), np.ones(3))
    text = "one or more words " * 50
    whole, n = model.margins([text])
    monkeypatch.setattr(language_id, "SLICE", 64)
    cut, m = model.margins([text])
    assert n == m and np.allclose(whole, cut, atol=1e-3)


# -- Jaccard join


def test_bands_reach_the_recall():
    bands, hashes = jaccard_join.choose_bands()
    assert 1 - (1 - 0.8**hashes) ** bands >= 0.999 and bands * hashes <= 256


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_join_matches_all_pairs(spark, block):
    docs = read(spark, "documents")
    rnd = random.Random(2)
    base = [f"u{i}" for i in range(120)]
    near = [(10_000 + i, " ".join(w if rnd.random() > 0.006 else f"n{i}" for w in base)) for i in range(25)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    got = rows(jaccard_join.jaccard_join(table, block=block), "doc_id", "class_id", "n_links")
    want = jaccard_classes(rows(table, "doc_id", "text"))
    assert sorted(got) == sorted(want)
    assert len([1 for d, c, n in want if n and d >= 10_000]) > 15


def test_jaccard_join_awkward_tables(spark):
    table = awkward(spark)
    got = rows(jaccard_join.jaccard_join(table), "doc_id", "class_id", "n_links")
    assert sorted(got, key=str) == sorted(jaccard_classes(rows(table, "doc_id", "text")), key=str)
    assert jaccard_join.jaccard_join(empty(spark)).count() == 0
    kept = jaccard_join.keep_one(table)
    assert kept.columns == table.columns
    left = [r[0] for r in rows(kept, "doc_id")]
    assert sorted(left, key=str) == sorted([1, 2, 3, 4, 6, 9, 10, None, 11, 12, 13], key=str)


def test_keep_one_of_each_class_though_ids_repeat(spark):
    """A merged table: one id, several texts, each of a class of its own or of another's."""
    near = BASE.replace("w30 ", "changed ")
    texts = [(1, BASE), (2, "some text of its own"), (2, near), (2, "another text of its own"), (2, "some text of its own"), (3, near), (4, "some text of its own")]
    texts += [(5, ""), (5, None), (6, "the last one"), (0, "the last one"), (None, BASE), (None, "only here")]
    docs = spark.createDataFrame([row(*t) for t in texts], SCHEMA)
    kept = rows(jaccard_join.keep_one(docs), "doc_id", "text")
    want = [(1, BASE), (2, "some text of its own"), (2, "another text of its own"), (5, ""), (5, None), (0, "the last one"), (None, BASE), (None, "only here")]
    assert sorted(map(str, kept)) == sorted(map(str, want))


# -- language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs.filter(~language_id.held_out()))
    assert model.code.shape == (4, 7)
    got = rows(language_id.identify(docs, model).filter(language_id.held_out()), "lang", "language.lang", "language.score")
    assert sum(a == b for a, b, _ in got) / len(got) > 0.98
    assert all(0 <= s <= 1 for *_, s in got)


def test_language_awkward_tables(spark):
    table = awkward(spark)
    model = language_id.fit(table)
    assert model.languages == ["en", "fr"]
    got = {r[0]: r[1:] for r in rows(language_id.identify(table.withColumnRenamed("h", "language"), model), "doc_id", "language_.lang", "language_.score")}
    assert {d for d, (lang, _) in got.items() if lang == "und"} == {1, 2, 3, 11}
    assert [x[0] for x in model.predict(["\U0001F600 12", "\u2460 \U0001D7CE"])] == ["und", "und"]  # no letters
    assert model.predict(["\U00010400 a"])[0][0] != "und"
    assert language_id.identify(empty(spark), model).count() == 0
    nothing = language_id.fit(empty(spark))
    assert {r[0] for r in rows(language_id.identify(table, nothing), "language.lang")} == {"und"}
    one = language_id.fit(table.filter("lang = 'fr'"))
    assert {r[0] for r in rows(language_id.identify(table, one), "language.lang")} == {"fr", "und"}


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = language_id.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2) and set(code.ravel()) <= {1.0, -1.0}


# -- quality


def test_quality_of_unseen_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter("doc_id % 3 <> 0"))
    unseen = labels.filter("doc_id % 3 = 0").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, model).select("doc_id", "quality.keep", "quality.score")
    got = rows(scored.join(unseen, "doc_id"), "doc_id", "keep", "score", "label")
    assert sum(keep == (q == 1) for _, keep, _, q in got) / len(got) > 0.93
    assert all(0 <= s <= 1 for _, _, s, _ in got)


def test_rare_languages_are_learned_from_large_tables(spark):
    rnd = random.Random(6)
    words = {"aa": "sol luna mar cielo".split(), "bb": "wald berg fluss stein".split(), "rare": "zyx qwv kjh xzq".split()}
    lang = ["aa", "bb"] * 1500 + ["rare"] * 8
    docs = spark.createDataFrame([(i, " ".join(rnd.choice(words[x]) for _ in range(12)), x) for i, x in enumerate(lang)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, sample=100, least=20)
    assert model.languages == ["aa", "bb", "rare"] and model.predict(["qwv zyx kjh"])[0][0] == "rare"
    assert language_id.fit(docs, sample=100, most=2).languages == ["aa", "bb"]


@pytest.mark.parametrize("sample", [300, 100_000])
def test_rounds_never_lower_the_scores_of_unseen_labels(spark, sample):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.pmod(F.xxhash64(F.lit("unseen"), "doc_id"), F.lit(3)) == 0
    areas = []
    for rounds in (0, quality.ROUNDS):
        model = quality.fit(docs, labels.filter(~unseen), sample=sample, rounds=rounds)
        got = np.array(rows(quality.score(docs, model).join(labels.filter(unseen).dropna(subset=["quality"]).select("doc_id", F.col("quality").alias("y")), "doc_id"), "quality.score", "y"))
        areas.append(quality.area(got[:, 0], got[:, 1]))
    assert areas[1] >= areas[0] - 1e-4 and areas[1] > 0.99


def test_views_at_chance_may_not_teach():
    rnd = np.random.default_rng(1)
    good = (rnd.random(600) < 0.7).astype(float)
    assert quality.surest(rnd.normal(size=600), good) == (-np.inf, np.inf)
    low, high = quality.surest(good * 4 + rnd.normal(size=600), good)
    assert 0 < low <= high < 4
    assert quality.surest(np.zeros(600), good) == (-np.inf, np.inf)  # equal margins stand together
    assert quality.area(np.array([0.0, 1, 1, 2]), np.array([0.0, 0, 1, 1])) == 0.875


def test_quality_awkward_tables(spark):
    table = awkward(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 14)] + [(None, 1), (3, None)], "doc_id long, quality int")
    for some in (labels, labels.filter("quality = 1"), labels.limit(0)):
        scored = quality.score(table.withColumnRenamed("h", "quality"), quality.fit(table, some))
        assert scored.count() == len(AWKWARD) and scored.columns[-1] == "quality_"
    assert quality.score(empty(spark), quality.fit(empty(spark), labels)).count() == 0


# -- secrets


def test_secret_spans(spark):
    text = 'part = "zX9kd82Lq0pW"\napi_key = part\nname = "nothing here"\npassword: "s3cr3tPa55word!"'
    docs = spark.createDataFrame([row(1, text), *AWKWARD], SCHEMA)
    got = {(r[0], r[1]) for r in rows(secret_scan.scan(docs), "doc_id", "spans") if r[1]}
    at, pw = text.index("zX9"), text.index("s3cr")
    one = next(s for d, s in got if d == 1)
    assert f"lexed:{at}:{at + 12}" in one and f"lexed:{pw}:{pw + 15}" in one and "nothing" not in one
    thirteen = next(s for d, s in got if d == 13)
    assert thirteen == "assign:0:25,lexed:9:25,access:27:47,hex:48:64"
    assert len(got) == 2 and secret_scan.scan(empty(spark)).count() == 0


CHAIN = ["part", *"bcdefghijk"]


@pytest.mark.parametrize(
    ("middle", "last"), [("f(part=part)\n" * 9, "part"), ("".join(f"{b} = {a}\n" for a, b in zip(CHAIN, CHAIN[1:], strict=False)), "k")]
)
def test_constants_pass_any_number_of_names(middle, last):
    """Nine passes of a name to itself, and a chain of ten names."""
    text = f'part = "zX9kd82Lq0pW"\n{middle}api_key = {last}\n'
    at = text.index("zX9")
    assert secret_scan.lexed_spans(text) == [(at, at + 12, "lexed")]


def test_names_of_any_length():
    for name in ("x" * 500 + "_api_key", "a.b-" * 100 + "api_key", "--9z-api_key", "1.api_key"):
        text = f'{name} = "zX9kd82Lq0pW"'
        assert secret_scan.lexed_spans(text) == [(len(name) + 4, len(name) + 16, "lexed")]
    for run in ("a-" * 500_000, "a" * 1_000_000, "1a." * 300_000, "-" * 1_000_000):  # each is read once
        assert secret_scan.lexed_spans(run + "?=") == []


def test_base_spans_are_ascii_and_leftmost():
    assert secret_scan.base_spans("paſſword=abcdefghijklmn") == []
    assert secret_scan.base_spans("token=secret=abcdefghij") == [(0, 23, "assign")]
    assert secret_scan.base_spans("secret=short token: 'abcdefghijkl'") == [(13, 33, "assign")]
    assert secret_scan.base_spans("AKIA1234 xAKIAABCDEFGHIJKLMN") == [(10, 28, "access")]
    assert secret_scan.base_spans("0123456789abcde 0123456789abcdefF") == [(16, 32, "hex")]


SYNTAX = [
    'api_key = part = "{}"', 'api_key = part\npart = "{}"', 'password = os.getenv("DB_PASSWORD", "{}")', 'set_password("{}")', '{{"api_key": ["{}"]}}',
    '<add key="api_key" value="{}"/>', 'api_key =\n    "{}"', 'client.secret := `{}`', "secret: '{}'", 'DB_PASSWORD={}', 'auth_token => "{}",', 'x(password="{}")',
    'part = "{}"\nf(secret=part)', 'const apiSecret: string = "{}";', 'passwords = ("{}", other)', 'authorization: "{}"',
]
CLEAN = [
    'part = "{}"\npart = os.environ\napi_key = part', 'name = "{}"', 'checksum("{}")', '<add key="colour" value="{}"/>', 'secret = load(path)', 'version: "{}"',
    'print("see {} there")', 'password = os.getenv("DB_PASSWORD_STAGING")', 'token = tokenizer.next', 'if token:\n    "what a token is"', 'public_key_path = "{}"', 'list = ["{}"]',
]


def test_planted_literals_are_found_and_others_are_not():
    rnd = random.Random(7)
    good = bad = total = 0
    for _ in range(40):
        for template, wanted in [*((t, True) for t in SYNTAX), *((t, False) for t in CLEAN)]:
            value = "".join(rnd.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(rnd.randrange(16, 40)))
            text = "some prose before.\n" + template.format(value) + "\nand after, too"
            spans = [text[a:b] for a, b, _ in secret_scan.lexed_spans(text)]
            total += wanted
            good += wanted and value in spans
            bad += len([x for x in spans if not wanted or x != value])
    assert good / total >= 0.98 and good / (good + bad) >= 0.99, (good, bad, total)


def test_lexer_is_linear_on_awkward_runs():
    for run in ('a=["' * 200_000, "x: (a, " * 200_000, 'f("' * 200_000, "<a " * 300_000, "((((" * 300_000, 'k = ["a", ' * 100_000, "a = b\n" * 200_000):
        secret_scan.lexed_spans(run)


def test_base_columns_match_a_plain_loop_over_a_whole_table(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    want = []
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for d, t in rows(table, "doc_id", "text"):
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        n = [sum(k == i for _, k, _ in found) for i in range(3)]
        want.append((d, *n, ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))))
    got = rows(secret_scan.scan(table), "doc_id", "n_assign", "n_access", "n_hex", "base_spans")
    assert sorted(got) == sorted(want) and sum(r[1] for r in got) > 10
