"""Spelling variants, source divergence and SuperMinHash groups against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from fundscape.llm import divergence, spelling, superminhash
from tests.llm.helpers import AWKWARD, LOWER, SCHEMA, awkward, empty, row

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# -- spelling variants


def brute_words(docs, least=7, occurrences=2):
    n = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= occurrences}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = defaultdict(list)
    for a, b in combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def test_variants_match_brute_force(spark):
    rnd = random.Random(1)
    words = ["aaaaaaaa", "aaaaaaa", "aaaaaaab", "baaaaaaa", "spelling", "spellling", "speling", "spelllling", "gründung", "grundung", "gr×ndung", "ÉCOLESXX", "écolesxx"]
    many = ["governs"] * 1100 + ["governs"[:3] + "x" + "governs"[4:]] * 110 + ["goxxrns"] * 11 + ["goxxrxs"] * 2
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60)))) for i in range(80)]
    docs += [(1000 + i, " ".join(many[i::10])) for i in range(10)] + [(None, "aaaaaaaa; spelling"), (None, "spelling"), (7, None), (8, ""), (9, "ш" * 9 + " 𝒳𝒳governs𝒳")]
    table = spark.createDataFrame([row(*d) for d in docs], SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in rows(spelling.group_variants(table), "word", "form", "root", "n", "n_near", "form_n")}
    want = brute_variants(brute_words(docs))
    assert got == want
    assert any(f for f, *_ in want.values()) and any(form and root != form for form, root, *_ in want.values())


def test_variants_over_a_table_and_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plain = [*rows(docs), *[r[:2] for r in AWKWARD]]
    table = spark.createDataFrame([row(*r) for r in plain], SCHEMA).withColumnRenamed("h", "word").withColumnRenamed("_0", "n")
    got = {r[0]: tuple(r[1:]) for r in rows(spelling.group_variants(table), "word", "form", "root", "n", "n_near", "form_n")}
    n = brute_words(plain)
    assert {w: r[2] for w, r in got.items()} == n
    close = defaultdict(set)  # words with a deletion in common, which near ones have
    for w in n:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            close[x].add(w)
    near = {w: {v for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for v in close[x] if one_edit(w, v)} for w in n}
    assert {w: r[3] for w, r in got.items()} == {w: len(v) for w, v in near.items()}
    assert spelling.group_variants(empty(spark)).count() == 0


def test_long_texts_count_whole(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    text = "spelling " * 50 + "x" * 40 + " Spelling"
    assert spelling.document_words("1", text, every=None) == {b"spelling": 51, b"x" * 40: 1}


# -- source divergence


def brute_audit(docs, least=10, best=10):
    groups, counts, df = {(lang or "", s or "") for _, lang, s in docs}, defaultdict(Counter), defaultdict(Counter)
    for text, lang, s in docs:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", s or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, c in df[lang].items() if c >= least)
        sources = sorted(s for x, s in groups if x == lang)
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: share(counts[lang, s]) for s in sources}, share(total)

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, best)):
                for i, (item, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]):
                    out.add((lang, s, part, item, v, i + 1))
    return out


def test_audit_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(2)
    terms = [f"t{chr(97 + i % 26)}{'é' * (i // 26)}" for i in range(90)]
    docs = []
    for i in range(260):
        lang, source = rnd.choice(["en", "en", "de", None]), rnd.choice(["a", "a", "a", "b", "é", None])
        words = [terms[min(int(rnd.expovariate(0.05 if source == "a" else 0.09)), 89)] for _ in range(rnd.randrange(0, 60))]
        docs.append((" ".join(words).upper() if i % 3 else "1".join(words), lang, source))
    docs += [(None, "fr", "x"), ("", "fr", "y"), ("alone", "fr", None), ("only one group here", "xx", "z"), *docs[:30]]
    table = spark.createDataFrame([(i, t, lang, s, 1, "p", "v", "n") for i, (t, lang, s) in enumerate(docs)], SCHEMA)
    table = table.withColumnRenamed("exact", "value").withColumnRenamed("h", "term")
    assert set(rows(divergence.audit(table))) == brute_audit(docs)


def test_audit_awkward_tables(spark):
    docs = [(r[1], r[2], r[3]) for r in AWKWARD]
    got = rows(divergence.audit(awkward(spark), least=2))
    assert len(got) == len(set(got)) and set(got) == brute_audit(docs, least=2)
    assert divergence.audit(empty(spark)).count() == 0


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_keeps_what_fewer_than_k_dominate(k):
    rnd = random.Random(k)
    points = [(c := rnd.randrange(1, 30), c + rnd.randrange(0, 40), f"w{rnd.randrange(10_000)}".encode()) for _ in range(700)]
    points = list({t: (c, n, t) for c, n, t in points}.values())
    band = divergence.Skyband(k)
    for a in range(0, len(points), 90):  # in parts
        some = points[a : a + 90]
        band.add(np.array([p[0] for p in some]), np.array([p[1] for p in some]), [p[2] for p in some])
        band.sift()
    want = {t for c, n, t in points if sum(c2 >= c and n2 <= n and t2 < t for c2, n2, t2 in points) < k}
    assert set(band.term) == want and 0 < len(want) < len(points)


def test_shares_are_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000_000
    df = spark.createDataFrame([(big, 3 * big, 1000)], "count long, n long, v long").select(divergence.share("count", "n").alias("p"))
    assert df.first()[0] == 1 + 1_000_000_000 * (big + 2) // (3 * big + 2000)


# -- SuperMinHash


def brute_groups(docs):
    sets = []
    for d, text in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
        sets.append((d, frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return Counter((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, (d, s) in enumerate(sets))


@pytest.mark.parametrize("block", [256, 4])
def test_groups_match_all_pairs(spark, block):
    docs = rows(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")
    rnd = random.Random(3)
    base = [f"u{i}" for i in range(100)]
    docs += [(10_000 + i, " ".join(w if rnd.random() > 0.03 else f"n{i}" for w in base)) for i in range(40)]
    docs += [(11_000 + i, " ".join([f"c{j}" for j in range(i, i + 30)])) for i in range(25)]  # a chain
    docs += [r[:2] for r in AWKWARD] + [(500_000, "one"), (500_001, "ONE"), (None, " ".join(base))]
    table = spark.createDataFrame([row(*r) for r in docs], SCHEMA).withColumnRenamed("h", "kept").withColumnRenamed("_0", "n")
    got = rows(superminhash.near_groups(table, block=block), "doc_id", "n_shingles", "component_id", "kept")
    assert Counter(got) == brute_groups(docs)


def test_groups_of_an_empty_table(spark):
    assert superminhash.near_groups(empty(spark)).count() == 0


def test_slots_agree_as_often_as_sets():
    """Unbiased, with less variance than independent hashes, whatever the batches."""
    rnd = np.random.default_rng(4)
    slots, share, runs = 186, 0.8, 300
    agree = []
    for _ in range(runs):
        x = rnd.integers(0, 1 << 62, 90, dtype=np.uint64)
        a, b = np.unique(x[:81]), np.unique(x[9:])  # 72 of 90 in common
        s = superminhash.superminhash([a, b], slots)
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - share) < 0.01 and np.var(agree) < 0.8 * share * (1 - share) / slots
    sets = [np.unique(rnd.integers(0, 1 << 62, n, dtype=np.uint64)) for n in (1, 2, 50, 3000, 40_000, 7)]
    alone = np.concatenate([superminhash.superminhash([s], slots) for s in sets])
    assert (superminhash.superminhash(sets, slots) == alone).all()
    one = alone[0]
    assert sorted(one >> np.uint64(32)) == list(range(slots))  # a single element fills one slot a step


def test_recall_wanted():
    bands, hashes = superminhash.choose_bands(0.8, superminhash.RECALL, superminhash.SLOTS)
    assert 1 - (1 - 0.8**hashes) ** bands >= 0.9999 and bands * hashes <= 256
