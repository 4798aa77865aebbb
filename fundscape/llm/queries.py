"""The thin queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscape.llm import (
    decontamination, divergence, exact_dedup, jaccard_join, language_id, mixing, quality, secret_scan, sharding, spelling, superminhash, token_store, warc,
)
from fundscape.llm.common import shared_dir, table

SHARDS = 24
END_ID = 2

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = shared_dir(spark, "warc")
    records = warc.read_archives(spark, path, warc.write_archives(pages, path)).filter("entry = 'record'")
    id_type = pages.schema["page_id"].dataType
    return records.select(
        F.col("source_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "exact.keep_id", "exact.group_size", "exact.kept", "exact.text_sha256")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "leak.n_words", "leak.n_hit", F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"), (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~language_id.held_out()))
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", language_id.held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.ambiguous"
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "quality.score", "quality.keep", "quality.text_score", "quality.meta_score")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_lexed"
    )


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_store.token_digest(spark, docs, shared_dir(spark, "token-store"), token_store.tokenizer_path(), END_ID)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_warc": op2_warc,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_store": op10_token_store,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_source_divergence": op12_source_divergence,
    "op13_superminhash": op13_superminhash,
}

SQL: dict[str, str] = {
    "op2_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages
        ), fives AS (
            SELECT *, list_transform(range(8), lambda j: ('0x' || substr(hex, 1 + 5 * j, 5))::BIGINT) AS v FROM p
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((v[1 + i // 4] >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM fives""",
    "op3_exact_dedup": """
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS n FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
        FROM t""",
    "op4_decontamination": r"""
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), bw AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), bwin AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS k, w[i : i + least(len(w), 10) - 1] AS win
            FROM bw, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS r(i) WHERE len(w) > 0
        ), ks AS (SELECT DISTINCT k FROM bwin),
        dwin AS (
            SELECT doc_id, k, i, w[i : i + k - 1] AS win FROM dw, ks, unnest(range(1, len(w) - k + 2)) AS r(i) WHERE len(w) >= k
        ), hit AS (
            SELECT doc_id, i, d.k, item_id FROM dwin d JOIN bwin b ON d.k = b.k AND d.win = b.win
        ), words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, k FROM hit), unnest(range(i, i + k)) AS r(p)
            GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids
            FROM hit GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_jaccard_join": r"""
        WITH RECURSIVE docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), grams AS (
            SELECT r, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
            FROM docs, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p(i) WHERE len(w) > 0
        ), sets AS MATERIALIZED (SELECT r, list_sort(list(DISTINCT g)) AS s FROM grams GROUP BY r
        ), classes AS MATERIALIZED (
            SELECT row_number() OVER () AS c, s, len(s) AS n, min(doc_id) AS rep, count(*) AS weight
            FROM sets JOIN docs USING (r) GROUP BY s
        ), items AS (SELECT c, n, unnest(s) AS g FROM classes
        ), pairs AS (
            SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.g = b.g AND a.c < b.c
            GROUP BY a.c, b.c, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)
        ), links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
        ), reach(c, other) AS (
            SELECT c, c FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.other = links.a
        ), joined AS (SELECT reach.c, min(o.rep) AS class_id FROM reach JOIN classes o ON reach.other = o.c GROUP BY reach.c
        ), counts AS (SELECT a AS c, sum(weight) AS n FROM links JOIN classes ON b = c GROUP BY a
        )
        SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id,
               coalesce(weight - 1 + coalesce(counts.n, 0), 0)::BIGINT AS n_links, coalesce(rep, d.doc_id) AS copy_of
        FROM docs d LEFT JOIN sets USING (r) LEFT JOIN classes ON sets.s = classes.s
        LEFT JOIN joined ON joined.c = classes.c LEFT JOIN counts ON counts.c = classes.c""",
    # The crc32 of every distinct run of a document, a byte at a time, by a table of 256 remainders.
    "op11_spelling_variants": r"""
        WITH RECURSIVE bits(b, k, v) AS (
            SELECT range::UBIGINT, 0, range::UBIGINT FROM range(256)
            UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8
        ), crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8
        ), runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r(run)
        ), counted AS (
            SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x
            FROM runs WHERE length(run) >= 7 GROUP BY ALL
        ), hashed AS (
            SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(length(x) // 2),
                       lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT)),
                       lambda a, c: xor(a >> 8, t[1 + xor(a & 255, c)::BIGINT])), 4294967295::UBIGINT) AS h
            FROM counted, crc
        ), cut AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                   ELSE run END AS word, n FROM hashed
        ), words AS MATERIALIZED (
            SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ), gone AS MATERIALIZED (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM words, unnest(range(1, length(word) + 1)) AS r(i)
        ), near AS MATERIALIZED (
            SELECT a.word, b.word AS other, b.n AS m FROM gone a JOIN gone b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
            UNION SELECT g.word, w.word, w.n FROM gone g JOIN words w ON g.short = w.word
            UNION SELECT w.word, g.word, g.n FROM gone g JOIN words w ON g.short = w.word
        ), best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM near GROUP BY word
        ), formed AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), up(word, root) AS (
            SELECT word, word FROM formed UNION SELECT up.word, f.form FROM up JOIN formed f ON up.root = f.word WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN up USING (word) JOIN formed top ON up.root = top.word AND top.form IS NULL""",
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
        ), found AS MATERIALIZED (
            SELECT lang, source, term, count(*) AS c, count(DISTINCT r) AS d FROM docs, unnest(ts) AS u(term) GROUP BY ALL
        ), kept AS MATERIALIZED (SELECT lang, term, sum(c)::BIGINT AS total FROM found GROUP BY ALL HAVING sum(d) >= 10
        ), langs AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS n FROM kept GROUP BY lang
        ), sources AS (SELECT DISTINCT lang, source FROM docs
        ), sizes AS (SELECT lang, source, sum(c)::BIGINT AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL
        ), cells AS MATERIALIZED (
            SELECT s.lang, s.source, k.term, coalesce(f.c, 0) AS c,
                   (1 + 1000000000::HUGEINT * (coalesce(f.c, 0) + 2) // (coalesce(z.n, 0) + 2 * l.v)) AS p,
                   (1 + 1000000000::HUGEINT * (k.total + 2) // (l.n + 2 * l.v)) AS q
            FROM sources s JOIN langs l USING (lang) JOIN kept k USING (lang)
            LEFT JOIN found f USING (lang, source, term) LEFT JOIN sizes z USING (lang, source)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
            FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), every AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
        ), ranked AS (
            SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank
            FROM every
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT AS value,
                   row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // (p + q) DESC, encode(term))
            FROM cells WHERE c > 0 AND p > q
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_superminhash": r"""
        WITH RECURSIVE docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), grams AS (
            SELECT r, array_to_string(w[i : i + least(len(w), 2) - 1], ' ') AS g
            FROM docs, unnest(range(1, len(w) - least(len(w), 2) + 2)) AS p(i) WHERE len(w) > 0
        ), sets AS MATERIALIZED (SELECT r, list_sort(list(DISTINCT g)) AS s FROM grams GROUP BY r
        ), classes AS MATERIALIZED (
            SELECT row_number() OVER () AS c, s, len(s) AS n, min(doc_id) AS rep FROM sets JOIN docs USING (r) GROUP BY s
        ), items AS (SELECT c, n, unnest(s) AS g FROM classes
        ), links AS MATERIALIZED (
            SELECT a.c AS a, b.c AS b FROM items a JOIN items b
            ON a.g = b.g AND a.c <> b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.c, b.c, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)
        ), reach(c, other) AS (
            SELECT c, c FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.other = links.a
        ), found AS (SELECT reach.c, min(o.rep) AS component_id FROM reach JOIN classes o ON reach.other = o.c GROUP BY reach.c)
        SELECT d.doc_id, coalesce(classes.n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
               coalesce(component_id, d.doc_id) IS NOT DISTINCT FROM d.doc_id AS kept
        FROM docs d LEFT JOIN sets USING (r) LEFT JOIN classes ON sets.s = classes.s LEFT JOIN found ON found.c = classes.c""",
}
