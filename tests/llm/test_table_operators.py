"""Sharding, WARC, exact dedup, mixing and token output."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscape.llm import exact_dedup, mixing, sharding, token_store, warc
from fundscape.llm.common import shared_dir
from tests.llm.helpers import AWKWARD, awkward, crc, empty, greedy_capacity

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# -- sharding


def check_shards(docs, shards, **options):
    texts = rows(docs, "doc_id", "text")
    got = rows(sharding.shard_by_bytes(docs, shards, **options), "doc_id", "size", "text_crc32", "shard", "slot", "capacity")
    want = [(d, len((t or "").encode()) + 8, crc((t or "").encode())) for d, t in texts]
    assert sorted((r[:3] for r in got), key=str) == sorted(want, key=str)
    groups = defaultdict(int)
    for (_, t), (_, size, _) in zip(texts, want, strict=True):
        groups[hashlib.sha256((t or "").encode()).digest()] += size
    large, left = [], sum(groups.values())
    for k in sorted(groups, key=lambda k: (-groups[k], k)):  # groups above an even share are alone
        if len(large) == shards - 1 or groups[k] * (shards - len(large)) <= left:
            break
        large.append(groups.pop(k))
        left -= large[-1]
    sizes = [groups[k] for k in sorted(groups)]
    if got:
        assert {r[5] for r in got} == {max([greedy_capacity(sizes, shards - len(large)), *large])}
    by = defaultdict(list)
    for _, size, _, shard, slot, capacity in got:
        by[shard].append((slot, size))
    for parts in by.values():
        assert sorted(s for s, _ in parts) == list(range(len(parts)))
        assert sum(n for _, n in parts) <= got[0][5]
    assert all(0 <= s < shards for s in by)
    homes = defaultdict(set)
    for d, _, _, shard, *_ in got:
        for i, t in texts:
            if i == d:
                homes[t or ""].add(shard)
    assert all(len(v) == 1 for v in homes.values())


@pytest.mark.parametrize("resolution", [sharding.RESOLUTION, 5])
def test_shards_are_minimax(spark, resolution):
    check_shards(read(spark, "documents"), 24, resolution=resolution)


def test_large_groups_leave_even_shards(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "a copy").when(F.col("id") % 7 == 0, "another copy").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"),
    )
    check_shards(docs, 8)
    sizes = [r[0] for r in sharding.shard_by_bytes(docs, 8).groupBy("shard").agg(F.sum("size").alias("n")).orderBy(F.desc("n")).select("n").collect()]
    assert len(sizes) == 8 and sizes[2] - sizes[-1] < 0.02 * sizes[2]


def test_shards_awkward_tables(spark):
    check_shards(awkward(spark), 4)
    check_shards(awkward(spark), 1)
    check_shards(awkward(spark), 40)
    assert sharding.shard_by_bytes(empty(spark), 3).count() == 0


# -- WARC


def test_warc_round_trip(spark):
    pages = [(1, "http://a", "one"), (2, None, "two"), (3, "http://c", "one"), (4, "http://d", None), (5, "http://e", ""), (None, "http://f", "one"), (1, "http://a", "one")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS first")
    for gzip in (True, False):
        path = shared_dir(spark, "warc-test")
        made = warc.write_archives(table, path, gzip=gzip)
        got = rows(warc.read_archives(spark, path, made), "entry", "source_id", "record_type", "refers_to", "payload_bytes", "payload")
        assert Counter(r[0] for r in got) == {"record": 7}
        kinds = Counter(r[1:5] for r in got)
        assert kinds == Counter(
            {("1", "response", None, 3): 2, ("2", "response", None, 3): 1, ("3", "revisit", "1", 3): 1, ("4", "response", None, 0): 1,
             ("5", "revisit", "4", 0): 1, (None, "revisit", "1", 3): 1}
        )
        assert {bytes(r[5]) for r in got if r[2] == "response"} == {b"one", b"two", b""}
    none = warc.write_archives(table.limit(0), shared_dir(spark, "warc-test"))
    assert none.count() == 0


@pytest.mark.parametrize("gzip", [True, False])
def test_salvage_keeps_all_but_the_damaged(gzip, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 1000)
    rnd = random.Random(4)
    made = [warc.record(str(i), f"http://x/{i}", rnd.randbytes(rnd.choice([0, 10, 900, 5000])), None) for i in range(30)]
    made = [warc.compress(r) if gzip else r for r in made]
    at = np.cumsum([0, *map(len, made)])
    bad = {4, 11, 12, 20}
    data = bytearray(b"".join(made))
    for i in bad:
        data[at[i] + len(made[i]) * 3 // 4] ^= 0xFF
    data += b"tail"
    out = list(warc.salvage(io.BytesIO(bytes(data)).read))
    assert out[0][1] == 0 and out[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(out, out[1:], strict=False))
    assert [o[4]["warc-source-id"] for o in out if o[0] == "record"] == [str(i) for i in range(30) if i not in bad]
    assert [(o[1], o[2]) for o in out if o[0] == "gap"] == [(at[4], at[5]), (at[11], at[13]), (at[20], at[21]), (at[30], len(data))]
    assert all(o[3] for o in out if o[0] == "gap")


@pytest.mark.parametrize("gzip", [True, False])
def test_warc_long_urls(spark, gzip):
    """A url of any length comes back, also from the record behind a damaged one."""
    urls = {1: "data:," + "ab" * 150_000, 2: "http://x/" + "y" * 65_536, 3: "http://x"}
    table = spark.createDataFrame([(i, u, f"page {i}") for i, u in urls.items()], "page_id long, url string, html string")
    path = shared_dir(spark, "warc-test")
    read = warc.read_archives(spark, path, warc.write_archives(table, path, gzip=gzip))
    assert rows(read, "entry", "source_id", "url") == sorted(("record", str(i), u) for i, u in urls.items())
    made = [warc.record(str(i), u, b"page", None) for i, u in urls.items()] * 2
    made = [warc.compress(r) if gzip else r for r in made]
    data = bytearray(b"".join(made))
    for n in (1, 3):
        data[sum(map(len, made[:n])) - 5] ^= 255
    out = list(warc.salvage(io.BytesIO(bytes(data)).read))
    assert [(o[0], o[4].get("warc-source-id")) for o in out] == [
        ("gap", None), ("record", "2"), ("gap", None), ("record", "1"), ("record", "2"), ("record", "3")
    ]


def test_salvage_of_nothing_and_junk():
    assert list(warc.salvage(io.BytesIO(b"").read)) == []
    assert [o[:3] for o in warc.salvage(io.BytesIO(b"\x1f\x8b").read)] == [("gap", 0, 2)]
    assert [o[:3] for o in warc.salvage(io.BytesIO(b"x" * 50).read)] == [("gap", 0, 50)]


# -- exact dedup


@pytest.mark.parametrize(("bits", "capacity"), [(64, 4096), (64, 3), (3, 4)])
def test_exact_dedup_matches_grouping(spark, bits, capacity):
    table = read(spark, "documents").select("doc_id", "text")
    copies = spark.createDataFrame([(9000 + i, f"a  b{'\t' * (i % 3)} {i // 4}") for i in range(40)], table.schema)
    table = table.union(copies)
    got = rows(exact_dedup.dedup(table, bits=bits, capacity=capacity), "doc_id", "exact.keep_id", "exact.group_size", "exact.kept", "exact.text_sha256")
    groups = defaultdict(list)
    for d, t in rows(table, "doc_id", "text"):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    want = [(d, min(g), len(g), d == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g]
    assert sorted(got) == sorted(want)


def test_directory_splits_only_overfull_buckets(spark):
    entries = spark.range(3000).selectExpr("xxhash64(id) AS h")
    pointers, depth = exact_dedup.directory(entries, shared_dir(spark, "directory"), 100)
    slots = rows(pointers, "slot", "bucket_depth", "n")
    assert sorted(s for s, *_ in slots) == list(range(1 << depth))
    assert all(n <= 100 for *_, n in slots) and len({d for _, d, _ in slots}) > 1


def test_exact_dedup_awkward_tables(spark):
    table = awkward(spark)
    out = exact_dedup.dedup(table)
    assert out.columns == [*table.columns, "exact_"]
    got = {r[0]: r[1:] for r in rows(out, "doc_id", "exact_.keep_id", "exact_.group_size", "exact_.kept")}
    assert got[1] == (1, 2, True) and got[2] == (1, 2, False) and got[3] == (3, 1, True)
    assert got[5] == (4, 3, False) and got[None] == (None, 1, False)
    assert out.count() == len(AWKWARD) and exact_dedup.dedup(empty(spark)).count() == 0


# -- mixing


def water_filled(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left, free = total - sum(most * sizes[s] for s in capped), [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {**{s: float(most * sizes[s]) for s in capped}, **share}
        capped |= over


def test_mix_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = rows(mixing.mix(docs), "doc_id", "source", "size", "source_size", "target", "copies")
    text = dict(rows(docs, "doc_id", "text"))
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, s, n, *_, c in got:
        assert n == len(re.findall(r"[^\x20\x09-\x0D]+", text[d])) and 0 <= c <= 3
        sizes[s] += n
        taken[s] += n * c
    targets = water_filled(sizes)
    for _, s, _, total, target, _ in got:
        assert total == sizes[s] and target == pytest.approx(targets[s])
    assert all(abs(taken[s] / targets[s] - 1) < 0.02 for s in sizes)
    assert sorted(got) == sorted(rows(mixing.mix(docs.repartition(3)), "doc_id", "source", "size", "source_size", "target", "copies"))


def test_mix_awkward_tables(spark):
    table = awkward(spark)
    got = rows(mixing.mix(table), "source", "size", "target", "copies")
    sizes = defaultdict(int)
    for s, n, *_ in got:
        sizes[s] += n
    targets = water_filled(sizes)
    assert len(got) == len(AWKWARD) and all(t == pytest.approx(targets[s]) and c <= 3 for s, _, t, c in got)
    small = rows(mixing.mix(table.filter("doc_id IN (10, 1)")), "source", "target", "copies")
    assert sorted(small) == [("a", 0.0, 0), ("b", 3.0, 1)]
    assert mixing.mix(empty(spark)).count() == 0
    again = mixing.repeated(table)
    assert again.columns == table.columns and again.count() == sum(c for *_, c in got)


# -- token output


def brute_tokens(docs, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_store.tokenizer_path())
    out, start = {}, 0
    for d, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        out.setdefault(d, []).append((start, len(ids), crc(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_tokens_round_trip(spark):
    docs = read(spark, "documents")
    got = rows(token_store.token_digest(spark, docs, shared_dir(spark, "tokens"), token_store.tokenizer_path(), 2), "doc_id", "start", "n_tokens", "ids_crc32")
    want = brute_tokens(rows(docs, "doc_id", "text"), 2)
    assert sorted(got) == sorted((d, *x) for d, xs in want.items() for x in xs)


def test_tokens_awkward_tables(spark):
    docs = awkward(spark)
    store = token_store.write_store(docs, shared_dir(spark, "tokens"), token_store.tokenizer_path(), 2)
    keys = docs.select("doc_id").distinct().union(spark.createDataFrame([(77,), (-5,)], "doc_id long"))
    got = rows(token_store.read_keys(keys, store, wide=True), "doc_id", "start", "n_tokens", "ids")
    want = brute_tokens(rows(docs, "doc_id", "text"), 2)
    assert sorted(((d, s, n, zlib.crc32(bytes(b))) for d, s, n, b in got), key=str) == sorted(((d, *x) for d, xs in want.items() for x in xs), key=str)
    none = token_store.write_store(empty(spark), shared_dir(spark, "tokens"), token_store.tokenizer_path(), 2)
    assert none["rows"] == 0 and token_store.read_keys(keys, none).count() == 0


def test_encoder_by_words_is_exact():
    encode = token_store.Encoder(token_store.tokenizer_path())
    assert encode.by_word
    rnd = random.Random(3)
    signs = "ab'sStT0 9.,\n\t\r\x0b\x1c\x85\xa0éÉİıſßÑ²½ªº×÷̀́中😀_<|>-’"
    texts = ["", "It's 'street we'll 12.5 ** ''s", "<|endoftext|> a", "ŉ ſ straße ÀÉ Σς", *("".join(rnd.choices(signs, k=rnd.randrange(40))) for _ in range(5000))]
    for t in texts:
        ids = encode.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encode(t), encode.dtype).tolist() == ids


def test_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 20_000):
        h = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
        mph = token_store.build_mph(*h)
        assert sorted(token_store.find_slots(mph, *h).tolist()) == list(range(n))
    with pytest.raises(ValueError, match="share"):
        token_store.build_mph(np.ones(2, np.uint64), np.ones(2, np.uint64))


@pytest.mark.parametrize("gzip", [True, False])
def test_any_id_and_url_come_back(spark, gzip):
    ids = [" 7 ", "8", "a\r\nb", "", "été 100%", "x:y%0A", "\t", None]
    urls = ["http://x/a%20b", "http://x/a b", "line\r\nbreak", " http://é ", "", None, "http://x/?q=%25", "plain"]
    table = spark.createDataFrame([(i, u, "same" if n < 4 else f"p{n}") for n, (i, u) in enumerate(zip(ids, urls, strict=True))], "page_id string, url string, html string")
    path = shared_dir(spark, "warc-ids")
    got = rows(warc.read_archives(spark, path, warc.write_archives(table, path, gzip=gzip)), "entry", "source_id", "url", "refers_to")
    assert sorted(got, key=str) == sorted([("record", i, u or "", "" if n < 3 else None) for n, (i, u) in enumerate(zip(ids, urls, strict=True))], key=str)


def test_damaged_length_is_not_read_through():
    made = [warc.record(str(i), "u", b"x" * 1000, None) for i in range(3)]
    data = made[0] + made[1].replace(b"\r\nContent-Length: 10", b"\r\nContent-Length: 20000010", 1) + made[2] + b"\0" * (30 << 20) + made[0]
    f, most = io.BytesIO(data), [0]

    def read(n):
        most[0] += n
        return f.read(n)

    out = []
    for entry in warc.salvage(read, lambda at: data[at : at + 4]):
        out.append((entry[0], entry[4].get("warc-source-id"), most[0]))
        if len(out) == 3:
            break
    assert [x[:2] for x in out] == [("record", "0"), ("gap", None), ("record", "2")] and out[-1][2] <= 2 << 20
    assert [x[0] for x in warc.salvage(io.BytesIO(data).read, lambda at: data[at : at + 4])] == ["record", "gap", "record", "gap", "record"]


def test_repeated_rows_meet_the_targets(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j", f"s{i % 3}") for i in range(1200)], "doc_id long, text string, source string")
    got = rows(mixing.mix(docs), "source", "size", "target", "copies")
    target, taken = {r[0]: r[2] for r in got}, defaultdict(int)
    for s, size, _, copies in got:
        taken[s] += size * copies
    assert len(got) == 1200 and all(abs(taken[s] - t) <= 10 for s, t in target.items()) and min(target.values()) > 0
    assert sorted(got) == sorted(rows(mixing.mix(docs.repartition(7)), "source", "size", "target", "copies"))
    mixed = mixing.repeated(docs).groupBy("source").count().collect()
    assert {r["source"]: 10 * r["count"] for r in mixed} == dict(taken)
