"""SQL with the same results as the registered queries, over the same tables."""

from __future__ import annotations

from fundscape.constants import METRICS, PROJECTION_SHOCKS, SCORE_WEIGHTS
from fundscape.plans.views import ORDER_WEIGHTS, PATTERN, PREFIXES, STEMS, STOP_WORDS


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


RELEVANT = (
    " OR ".join(f"starts_with(topics, '{p}')" for p in PREFIXES)
    + f" OR coalesce(regexp_matches(objective, '{PATTERN}', 'i'), false)"
)

PROJECT = """project AS (
  SELECT o_orderkey AS id, o_orderpriority AS topics, text AS objective,
         CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'Signed' ELSE 'TERMINATED' END AS status,
         o_totalprice AS total_cost
  FROM orders LEFT JOIN documents ON o_orderkey = doc_id)"""

ORGANIZATION = """organization AS (
  SELECT l_orderkey AS "projectID", l_suppkey AS "organisationID", l_linenumber AS "order", n_name AS country,
         l_extendedprice AS ec, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 + l_tax) AS cost
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

MERGED = f"""merged AS (
  SELECT organization.*, topics, status, total_cost, objective
  FROM organization JOIN project ON "projectID" = id WHERE {RELEVANT})"""

COLLAB = """collab AS (
  SELECT "projectID" AS pid, count(DISTINCT country) AS n FROM merged GROUP BY 1)"""

GDP = """gdp AS (
  SELECT n_name AS iso2, sum(c_acctbal) AS gdp_2023 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""

TOTALS = """coalesce(sum(ec), 0) AS total_ec_contribution,
         count(DISTINCT "projectID") AS total_projects, count(DISTINCT "organisationID") AS unique_orgs"""

RATIOS = """avg(CASE WHEN n > 1 THEN 1.0::DOUBLE ELSE 0 END) AS collab_project_ratio,
         avg(CASE WHEN upper(status) = 'SIGNED' THEN 1.0::DOUBLE ELSE 0 END) AS signed_pct,
         avg(CASE WHEN upper(status) = 'CLOSED' THEN 1.0::DOUBLE ELSE 0 END) AS closed_pct,
         avg(CASE WHEN upper(status) = 'TERMINATED' THEN 1.0::DOUBLE ELSE 0 END) AS terminated_pct"""

GROUPED = f"""grouped AS (
  SELECT country, {TOTALS}, {RATIOS}
  FROM merged LEFT JOIN collab ON "projectID" = pid GROUP BY country)"""

BASE = """base AS (
  SELECT g.*, signed_pct + closed_pct - terminated_pct AS success_ratio,
         coalesce(gdp_2023, 0) AS gdp_2023, coalesce(total_ec_contribution / gdp_2023, 0) AS ec_per_gdp
  FROM grouped g LEFT JOIN gdp ON country = iso2
  WHERE country IN (SELECT n_name FROM nation WHERE n_regionkey <> 4))"""

SHARES = """shares AS (
  SELECT *, total_ec_contribution / sum(total_ec_contribution) OVER () AS funding_share,
         total_projects / max(total_projects) OVER () AS project_share,
         unique_orgs / max(unique_orgs) OVER () AS org_share
  FROM base)"""

SCALED = "scaled AS (\n  SELECT *, " + ",\n    ".join(
    f"CASE WHEN max({m}) OVER () > min({m}) OVER () THEN ({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER ()) "
    f"ELSE 0 END AS {m}_scaled"
    for m in METRICS
) + "\n  FROM shares)"

SCORED = (
    "scored AS (\n  SELECT *, ("
    + " + ".join(f"{c}" for c in SCORE_WEIGHTS)
    + ') / 6 AS "Score", '
    + " + ".join(f"{c} * {w}::DOUBLE" for c, w in SCORE_WEIGHTS.items())
    + ' AS "Weighted_Score" FROM scaled)'
)

# Scores where a metric may be missing: means are over the metrics there are.
GAPS = (
    "gaps AS (\n  SELECT *, list_avg(list_filter([" + ", ".join(SCORE_WEIGHTS) + '], lambda x: x IS NOT NULL)) AS "Score", '
    + " + ".join(f"{c} * {w}::DOUBLE" for c, w in SCORE_WEIGHTS.items())
    + ' AS "Weighted_Score", ' + " AND ".join(f"{m} IS NOT NULL" for m in METRICS) + " AS is_placed\n  FROM (SELECT *, "
    + ", ".join(
        f"CASE WHEN max({m}) OVER () > min({m}) OVER () THEN ({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER ()) "
        f"WHEN {m} IS NOT NULL THEN 0 END AS {m}_scaled"
        for m in METRICS
    )
    + " FROM shares))"
)

TO_MERGED = (PROJECT, ORGANIZATION, MERGED)
TO_SCORED = (*TO_MERGED, COLLAB, GDP, GROUPED, BASE, SHARES, SCALED, SCORED)

WEIGHTED = """weighted AS (
  SELECT country, "Weighted_Score",
         CASE WHEN max("Weighted_Score") OVER () > min("Weighted_Score") OVER ()
              THEN ("Weighted_Score" - min("Weighted_Score") OVER ()) / (max("Weighted_Score") OVER () - min("Weighted_Score") OVER ())
              ELSE 0 END AS ramp, false AS is_average
  FROM scored
  UNION ALL SELECT 'EU Average', avg("Weighted_Score"), NULL, true FROM scored)"""

TO_WEIGHTED = (*TO_SCORED, WEIGHTED)

FEATURE_COLUMNS = (
    "country, round(total_ec_contribution, 2) AS total_ec_contribution, total_projects, unique_orgs, "
    "round(gdp_2023, 2) AS gdp_2023, "
    + ", ".join(
        f"round({c}, 6) AS {c}"
        for c in (
            "collab_project_ratio", "signed_pct", "closed_pct", "terminated_pct", "success_ratio", "ec_per_gdp",
            "funding_share", "project_share", "org_share", *SCORE_WEIGHTS,
        )
    )
    + ', round("Score", 6) AS "Score"'
)

# Text: tokens and n-grams as in the text functions.
TOKENS = f"""tokens AS (
  SELECT doc_id,
         [t FOR t IN regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') IF t NOT IN ({_list(STOP_WORDS)})] AS w
  FROM documents)"""
RUNS = """runs AS (
  SELECT doc_id, unnest(w) AS phrase FROM tokens
  UNION ALL
  SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM tokens
  UNION ALL
  SELECT doc_id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM tokens)"""
CANDS = "cands AS (SELECT doc_id, phrase, count(*) AS tf FROM runs GROUP BY ALL)"
PHRASE_DF = "phrase_df AS (SELECT phrase, count(*) AS df FROM cands GROUP BY phrase)"
RELEVANCE = """relevance AS (
  SELECT doc_id, phrase, tf, df,
         round(tf * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)), 6) AS score
  FROM cands JOIN phrase_df USING (phrase))"""
TO_RELEVANCE = (TOKENS, RUNS, CANDS, PHRASE_DF, RELEVANCE)
TOPK = """topk AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, phrase) AS rank FROM relevance
  QUALIFY rank <= {k})"""
STEMMED = "stemmed AS (SELECT * FROM topk WHERE " + " OR ".join(f"contains(phrase, '{s}')" for s in STEMS) + ")"
TO_STEMMED = (*TO_RELEVANCE, TOPK.format(k=20), STEMMED)


# The choice of 5 of up to 20 phrases: all subsets once, the likeness of all pairs per text.
_FIVE = range(1, 6)
DIVERSE = (
    "sets AS (SELECT *, list_distinct(string_split(phrase, ' ')) AS words FROM topk)",
    """pairs_alike AS (
  SELECT a.doc_id, a.rank AS i, b.rank AS j, len(list_intersect(a.words, b.words)) AS common, len(a.words) + len(b.words) AS total
  FROM sets a JOIN sets b ON a.doc_id = b.doc_id AND a.rank < b.rank)""",
    """grid AS (
  SELECT m.doc_id, m.n, list(coalesce(common / (total - common), 0)::DOUBLE ORDER BY g.i, h.j) AS alike
  FROM (SELECT doc_id, max(rank) AS n FROM topk GROUP BY 1 HAVING max(rank) > 5) m, range(1, 21) g(i), range(1, 21) h(j)
  LEFT JOIN pairs_alike p ON p.doc_id = m.doc_id AND p.i = g.i AND p.j = h.j GROUP BY 1, 2)""",
    "subsets AS (\n  SELECT "
    + ", ".join(f"r{k}" for k in _FIVE)
    + ", row_number() OVER (ORDER BY "
    + ", ".join(f"r{k}" for k in _FIVE)
    + ") AS place\n  FROM "
    + ", ".join(f"range(1, 21) s{k}(r{k})" for k in _FIVE)
    + " WHERE r1 < r2 AND r2 < r3 AND r3 < r4 AND r4 < r5)",
    "choices AS (\n  SELECT doc_id, min({'likeness': round("
    + " + ".join(f"alike[(r{a} - 1) * 20 + r{b}]" for b in _FIVE for a in range(1, b))
    + ", 9), 'place': place}) AS best FROM grid JOIN subsets ON r5 <= n GROUP BY doc_id)",
    """diverse AS (
  SELECT topk.doc_id, rank, phrase, score FROM topk LEFT JOIN choices USING (doc_id) LEFT JOIN subsets ON place = best.place
  WHERE best IS NULL OR rank IN (r1, r2, r3, r4, r5))""",
)


# Noise: the first 32 bits of an MD5 as a fraction.
def _uniform(keys: str, stream: str, seed: int = 123) -> str:
    return f"((('0x' || substr(md5({keys} || '|{stream}|{seed}'), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def _normal(keys: str, stream: str) -> str:
    return f"(sqrt(-2 * ln({_uniform(keys, stream + '/r')})) * cos(2 * pi() * {_uniform(keys, stream + '/a')}))"


PAIRS = """pairs AS (
  SELECT a.n_name AS country, b.n_name AS peer FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 5
  WHERE a.n_regionkey <> 4 AND b.n_regionkey <> 4
    AND a.n_nationkey IN (SELECT s_nationkey FROM supplier) AND b.n_nationkey IN (SELECT s_nationkey FROM supplier))"""


def _peers(scores: str, key: str = "country") -> str:
    return f"""peers AS (
  SELECT pairs.country, pairs.peer, low."Weighted_Score" AS low_score, top."Weighted_Score" AS top_score,
         low."Weighted_Score" + 0.95::DOUBLE * (top."Weighted_Score" - low."Weighted_Score") AS target_score
  FROM pairs JOIN {scores} low ON low.country = pairs.country JOIN {scores} top ON top.country = pairs.peer)"""


def _paths(draws: int) -> tuple[str, ...]:
    cell = "country || '|' || draw || '|' || year"
    later = "country || '|' || draw || '|' || (year + 1)"
    shocked = ", ".join(str(y) for y in PROJECTION_SHOCKS)
    return (
        f"draws AS (SELECT unnest(range(1, {draws + 1}))::INTEGER AS draw)",
        f"""walk AS (
  SELECT country, draw, 2025 AS year, low_score AS score_current FROM peers, draws
  UNION ALL
  SELECT country, draw, year + 1, greatest(0, least(1, score_current + 0.01::DOUBLE * {_normal(later, 'current')}))
  FROM walk WHERE year < 2050)""",
        f"""paths AS (
  SELECT country, peer, draw, year, score_current, low_score, target_score,
         (year - 2025) / 25 AS progress,
         CASE WHEN year = 2025 THEN low_score ELSE greatest(0, least(1,
           low_score + (year - 2025) / 25 * (target_score - low_score)
           + 0.01::DOUBLE * (1 - (year - 2025) / 25) * {_normal(cell, 'improved')}
           - CASE WHEN year IN ({shocked}) THEN 0.02::DOUBLE + 0.04::DOUBLE * {_uniform(cell, 'shock')} ELSE 0 END)) END
         AS score_improved
  FROM walk JOIN peers USING (country))""",
    )


TO_PEERS = (*TO_SCORED, PAIRS, _peers("scored"))
TO_PATHS = (*TO_PEERS, *_paths(1))
NAMES = "names AS (SELECT 'NATION_' || (n_nationkey + 5) AS code, 'Nation no. ' || n_nationkey AS name FROM nation)"
SUMMARY = """CASE country WHEN 'NATION_0' THEN 'Prepared summary of nation 0.'
  WHEN 'NATION_1' THEN 'Prepared summary of nation 1.' ELSE '' END AS summary"""
PATH_NAMES = """LEFT JOIN names own ON own.code = country LEFT JOIN names other ON other.code = peer"""

# Orders with metrics of their line items, as in the view of that name.
ORDER_SCORES = (
    """wide AS (
  SELECT o_orderkey::VARCHAR AS order_id, o_totalprice AS price, count(*) AS lines, sum(l_quantity) AS quantity, avg(l_discount) AS discount,
         avg(l_tax) AS tax, count(DISTINCT l_suppkey) AS suppliers
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)""",
    "orders_scaled AS (SELECT *, "
    + ", ".join(f"({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER ()) AS {m}_scaled" for m in ORDER_WEIGHTS)
    + f""", {_uniform('order_id', 'holdout', 42)} < 0.2::DOUBLE AS is_test FROM wide)""",
    "orders_scored AS (SELECT *, ("
    + " + ".join(f"{m}_scaled" for m in ORDER_WEIGHTS)
    + f') / {len(ORDER_WEIGHTS)} AS "Score", '
    + " + ".join(f"{m}_scaled * {w}::DOUBLE" for m, w in ORDER_WEIGHTS.items())
    + ' AS "Weighted_Score" FROM orders_scaled)',
)

# Random indexing: a place and a sign for every word, summed over texts and over the words around a word.
VECTORS = (
    TOKENS,
    "occ AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM tokens)",
    """codes AS (
  SELECT word, {'dim': ('0x' || substr(md5(word), 1, 8))::BIGINT % 32, 'sign': CASE WHEN substr(md5(word), 9, 1) < '8' THEN 1 ELSE -1 END} AS c
  FROM (SELECT DISTINCT word FROM occ))""",
    """company AS (
  SELECT word, n.dim AS dim, sum(n.sign)::DOUBLE AS v FROM (
    SELECT word, unnest([lag(c, 1) OVER o, lag(c, 2) OVER o, lead(c, 1) OVER o, lead(c, 2) OVER o]) AS n
    FROM occ JOIN codes USING (word) WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) WHERE n IS NOT NULL GROUP BY 1, 2)""",
    "text_dims AS (SELECT doc_id, c.dim AS dim, sum(c.sign)::DOUBLE AS t FROM occ JOIN codes USING (word) GROUP BY 1, 2)",
    "norms AS (SELECT word, sum(v * v) AS norm FROM company GROUP BY 1)",
    "owns AS (SELECT doc_id, sum(t * t) AS own FROM text_dims GROUP BY 1)",
    """dots AS (
  SELECT d.doc_id, d.word, sum(t * v) AS dot FROM (SELECT DISTINCT doc_id, word FROM occ) d
  JOIN company ON company.word = d.word JOIN text_dims ON text_dims.doc_id = d.doc_id AND text_dims.dim = company.dim GROUP BY 1, 2)""",
    """placed AS (
  SELECT doc_id, pos, word, coalesce(dot, 0) AS dot, coalesce(norm, 0) AS norm
  FROM occ LEFT JOIN dots USING (doc_id, word) LEFT JOIN norms USING (word))""",
    """grams AS (
  SELECT doc_id, word AS phrase, 1 AS size, dot, norm FROM placed
  UNION ALL SELECT doc_id, word || ' ' || lead(word) OVER o, 2, dot + lead(dot) OVER o, norm + lead(norm) OVER o
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
  UNION ALL SELECT doc_id, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o, 3, dot + lead(dot) OVER o + lead(dot, 2) OVER o,
    norm + lead(norm) OVER o + lead(norm, 2) OVER o FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos))""",
    """near_phrases AS (
  SELECT doc_id, phrase, count(*) AS tf,
         max(coalesce(round(CASE WHEN norm * size * own > 0 THEN dot / (sqrt(norm) * sqrt(size * own)) END, 6), 0) + 0.0::DOUBLE) AS score
  FROM grams JOIN owns USING (doc_id) WHERE phrase IS NOT NULL GROUP BY 1, 2)""",
)

# Centres of the sources' texts, tf-idf in thousandths.
CENTRES = (
    TOKENS,
    "tfs AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM tokens) GROUP BY 1, 2)",
    """idfs AS (
  SELECT word, round(1000 * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)))::BIGINT AS idf FROM tfs GROUP BY 1)""",
    """centres AS (
  SELECT source AS cluster, word, round(sum(tf) * any_value(idf) / any_value(n))::BIGINT AS weight
  FROM tfs JOIN idfs USING (word) JOIN documents USING (doc_id) JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) USING (source)
  GROUP BY 1, 2)""",
    "lengths AS (SELECT cluster, sum(weight * weight) AS cc FROM centres GROUP BY 1)",
    "own_lengths AS (SELECT doc_id, sum((tf * idf) ** 2)::HUGEINT AS xx FROM tfs JOIN idfs USING (word) GROUP BY 1)",
    """meets AS (
  SELECT doc_id, cluster, sum(tf * idf * weight) AS xc FROM tfs JOIN idfs USING (word) JOIN centres USING (word) GROUP BY 1, 2)""",
    """choices AS (
  SELECT d.doc_id, cluster, coalesce(xx, 0) - 2 * coalesce(xc, 0) + cc AS distance
  FROM documents d CROSS JOIN lengths LEFT JOIN own_lengths USING (doc_id) LEFT JOIN meets USING (doc_id, cluster))""",
)

LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _scale(col: str) -> str:
    return f"round(({col} - min({col}) OVER ()) / (max({col}) OVER () - min({col}) OVER ()), 6)"


def _bins(table: str, key: str, col: str) -> str:
    return f"""WITH q AS (SELECT quantile_cont({col}, [0.2, 0.4, 0.6, 0.8]) AS e FROM {table})
SELECT {key}, {col}, (({col} > e[1])::INT + ({col} > e[2])::INT + ({col} > e[3])::INT + ({col} > e[4])::INT)::INT AS bin
FROM {table}, q"""


ORACLES: dict[str, str] = {
    "prefix_filter": "SELECT o_orderkey AS id, o_orderpriority AS topics FROM orders WHERE "
    + " OR ".join(f"starts_with(o_orderpriority, '{p}')" for p in PREFIXES),
    "prefix_complement": _with(PROJECT)
    + """SELECT id, topics FROM project
WHERE objective IS NULL OR NOT (starts_with(objective, 'The') OR starts_with(objective, 'Un'))""",
    "keyword_relevance": f"SELECT doc_id, coalesce(regexp_matches(text, '{PATTERN}', 'i'), false) AS relevant FROM documents",
    "relevant_projects": _with(PROJECT) + f"SELECT id, topics, objective, status FROM project WHERE {RELEVANT}",
    "distinct_statuses": _with(PROJECT) + "SELECT DISTINCT status FROM project",
    "parse_money": f"""SELECT {LINE_KEYS}, l_extendedprice AS from_european, l_extendedprice AS from_english,
  CASE WHEN l_extendedprice < 1000 THEN l_extendedprice END AS from_commas FROM lineitem""",
    "gdp_preprocess": """SELECT c_custkey, 'C' || c_nationkey AS code, n_name AS iso2,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS gdp_2023
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey + 5""",
    "code_lookup": """SELECT s_suppkey, s_nationkey::VARCHAR AS code, n_name AS name, coalesce(n_name, s_nationkey::VARCHAR) AS name_or_code
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey + 5""",
    "noise_uniform": f"SELECT o_orderkey, round({_uniform('o_orderkey::VARCHAR', 'demo')}, 9) AS u FROM orders",
    "holdout_split": f"""SELECT o_orderkey, {_uniform('o_orderkey::VARCHAR', 'holdout', 42)} < 0.2::DOUBLE AS is_test FROM orders""",
    "merge_projects": _with(*TO_MERGED)
    + """SELECT "projectID", "organisationID", country, round(ec, 4) AS "ecContribution", round(net, 4) AS "netEcContribution",
  round(cost, 4) AS "organisationTotalCost", topics, status, round(total_cost, 4) AS "projectTotalCost", "order" FROM merged""",
    "countries_per_project": _with(*TO_MERGED, COLLAB) + 'SELECT pid AS "projectID", n AS n_countries FROM collab',
    "collab_flag": _with(*TO_MERGED, COLLAB)
    + """SELECT "projectID", "organisationID", "order", country, n > 1 AS is_collab FROM merged JOIN collab ON "projectID" = pid""",
    "member_filter": _with(ORGANIZATION)
    + """SELECT "projectID", "organisationID", "order", country FROM organization
WHERE country IN (SELECT n_name FROM nation WHERE n_regionkey <> 4)""",
    "country_totals": _with(*TO_MERGED)
    + """SELECT country, round(coalesce(sum(ec), 0), 2) AS total_ec_contribution, count(DISTINCT "projectID") AS total_projects,
  count(DISTINCT "organisationID") AS unique_orgs FROM merged GROUP BY country""",
    "country_ratios": _with(*TO_MERGED, COLLAB, GROUPED)
    + """SELECT country, round(collab_project_ratio, 6) AS collab_project_ratio, round(signed_pct, 6) AS signed_pct,
  round(closed_pct, 6) AS closed_pct, round(terminated_pct, 6) AS terminated_pct,
  round(signed_pct + closed_pct - terminated_pct, 6) AS success_ratio FROM grouped""",
    "gdp_join": _with(*TO_MERGED, COLLAB, GDP, GROUPED)
    + """SELECT country, round(total_ec_contribution, 2) AS total_ec_contribution, total_projects, unique_orgs,
  round(coalesce(gdp_2023, 0), 2) AS gdp_2023, round(coalesce(total_ec_contribution / gdp_2023, 0), 6) AS ec_per_gdp
FROM grouped LEFT JOIN gdp ON country = 'NATION_' || (regexp_extract(iso2, '[0-9]+')::INT + 3)""",
    "participation_shares": _with(*TO_MERGED, COLLAB, GDP, GROUPED, BASE, SHARES)
    + """SELECT country, round(total_ec_contribution, 2) AS total_ec_contribution, total_projects, unique_orgs,
  round(funding_share, 6) AS funding_share, round(project_share, 6) AS project_share, round(org_share, 6) AS org_share
FROM shares""",
    "country_features": _with(*TO_SCORED) + f"SELECT {FEATURE_COLUMNS} FROM scored",
    "minmax_scale": f"""SELECT {LINE_KEYS}, l_extendedprice, l_discount, {_scale('l_extendedprice')} AS l_extendedprice_scaled,
  {_scale('l_discount')} AS l_discount_scaled, 0.0::DOUBLE AS flat_scaled FROM lineitem""",
    "row_mean_score": f"""SELECT {LINE_KEYS}, l_discount, l_tax, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS quantity,
  round(CASE WHEN l_returnflag = 'R' THEN (l_discount + l_tax + l_quantity) / 3 ELSE (l_discount + l_tax) / 2 END, 6) AS "Score"
FROM lineitem""",
    "weighted_score": _with(*TO_SCORED)
    + 'SELECT country, round("Score", 6) AS "Score", round("Weighted_Score", 6) AS "Weighted_Score" FROM scored',
    "quintile_bins": _bins("orders", "o_orderkey", "o_totalprice"),
    "quintile_labels": f"""SELECT *, ['lowest', 'low', 'middle', 'high', 'highest'][bin + 1] AS label
FROM ({_bins('customer', 'c_custkey', 'c_acctbal')})""",
    "with_average_row": _with(*TO_SCORED)
    + """SELECT country, round("Weighted_Score", 6) AS "Weighted_Score", total_projects FROM scored
UNION ALL SELECT 'EU Average', round(avg("Weighted_Score"), 6), NULL FROM scored""",
    "score_ramp": _with(*TO_WEIGHTED) + "SELECT country, round(ramp, 6) AS ramp, is_average FROM weighted",
    "country_scores": _with(*TO_WEIGHTED)
    + """SELECT country, round("Weighted_Score", 6) AS "Weighted_Score", round(ramp, 6) AS ramp, is_average FROM weighted
ORDER BY weighted."Weighted_Score" DESC, country""",
    "ranked_contributions": _with(*TO_WEIGHTED, NAMES)
    + """SELECT country, round("Weighted_Score", 6) AS "Weighted_Score", coalesce(name, country) AS full_name
FROM weighted LEFT JOIN names ON country = code ORDER BY weighted."Weighted_Score" DESC, country""",
    "unique_texts": """SELECT source || '/' || lang AS key, min(text) AS text FROM documents GROUP BY 1 ORDER BY 1""",
    "candidate_phrases": _with(TOKENS, RUNS, CANDS) + "SELECT doc_id, phrase, tf FROM cands",
    "phrase_relevance": _with(*TO_RELEVANCE) + "SELECT doc_id, phrase, tf, df, score FROM relevance",
    "phrase_topk": _with(*TO_RELEVANCE, TOPK.format(k=20)) + "SELECT doc_id, phrase, score, rank FROM topk",
    "phrase_diversify": _with(*TO_RELEVANCE, TOPK.format(k=20), *DIVERSE) + "SELECT doc_id, rank, phrase, score FROM diverse",
    "keyphrase_extraction": _with(*TO_RELEVANCE, TOPK.format(k=20), *DIVERSE)
    + "SELECT doc_id::VARCHAR AS project_id, string_agg(phrase, '; ' ORDER BY rank) AS phrases FROM diverse WHERE "
    + " OR ".join(f"contains(phrase, '{s}')" for s in STEMS)
    + " GROUP BY 1",
    "keyphrases_artifact": _with(*TO_STEMMED)
    + "SELECT doc_id::VARCHAR AS project_id, string_agg(phrase, '; ' ORDER BY rank) AS phrases FROM stemmed GROUP BY 1",
    "source_top_words": _with(TOKENS)
    + """SELECT 'topic_' || source AS topic, word, rank FROM (
  SELECT source, word, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, word) AS rank
  FROM (SELECT source, unnest(w) AS word FROM tokens JOIN documents USING (doc_id)) GROUP BY source, word) WHERE rank <= 15""",
    "importance_training": _with(*TO_SCORED)
    + "SELECT country, "
    + ", ".join(f"round({m}, {2 if m.startswith(('total_ec', 'gdp')) else 6}) AS {m}" for m in METRICS)
    + f""", round("Score", 6) AS "Score", {_uniform('country', 'holdout', 42)} < 0.2::DOUBLE AS is_test FROM scored""",
    "importance_artifact": _with(*TO_SCORED)
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS feature, round(abs(covar_pop({m}_scaled, "Score")), 6) AS importance FROM scored""" for m in METRICS
    ),
    "scores_with_gaps": _with(
        *TO_MERGED, COLLAB, GDP, GROUPED, BASE,
        SHARES.replace("FROM base", "FROM (SELECT * REPLACE (CASE WHEN NOT ends_with(country, '3') THEN ec_per_gdp END AS ec_per_gdp) FROM base)"),
        GAPS,
    )
    + """SELECT country, round("Score", 6) AS "Score", round("Weighted_Score", 6) AS "Weighted_Score", is_placed FROM gaps""",
    "projections_artifact": _with(*TO_PATHS, NAMES)
    + f"""SELECT country, string_agg(printf('%.6f', score_improved), ',' ORDER BY year) AS score_improved,
  coalesce(any_value(other.name), peer) AS top_country, {SUMMARY} FROM paths {PATH_NAMES} GROUP BY country, peer""",
    "raw_text_features": _with(*TO_SCORED) + f"SELECT {FEATURE_COLUMNS} FROM scored",
    "json_file_terms": "SELECT doc_id::VARCHAR AS project_id, unnest(string_split(text, '. ')) AS term FROM documents",
    "phrase_stem_filter": _with(*TO_STEMMED) + "SELECT doc_id, phrase, rank FROM stemmed",
    "project_keyphrases": _with(*TO_STEMMED)
    + "SELECT doc_id::VARCHAR AS project_id, string_agg(phrase, '; ' ORDER BY rank) AS phrases FROM stemmed GROUP BY 1",
    "term_counts": _with(*TO_STEMMED) + "SELECT phrase AS term, count(*) AS count FROM stemmed GROUP BY 1 ORDER BY 2 DESC, 1",
    "top_terms": _with(*TO_STEMMED)
    + "SELECT phrase AS term, count(*) AS count FROM stemmed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100",
    "importance_percent": _with(
        *TO_SCORED,
        "importance AS ("
        + " UNION ALL ".join(
            f"""SELECT '{m}' AS feature, abs(covar_pop({m}_scaled, "Score")) AS importance FROM scored""" for m in METRICS
        )
        + ")",
    )
    + """SELECT feature, round(importance, 6) AS importance,
  round(100 * importance / sum(importance) OVER (), 6) AS percent FROM importance""",
    "peer_lookup": _with(*TO_PEERS)
    + """SELECT country, peer, round(low_score, 6) AS low_score, round(top_score, 6) AS top_score,
  round(target_score, 6) AS target_score FROM peers""",
    "year_spine": "SELECT s_suppkey, (2025 + i)::INT AS year, i::INT AS i FROM supplier, range(26) t(i)",
    "projection_glide": _with(*TO_PATHS)
    + """SELECT country, year, round(progress, 6) AS progress,
  round(low_score + progress * (target_score - low_score), 6) AS glide FROM paths""",
    "projection_current": _with(*TO_PEERS, *_paths(3))
    + "SELECT country, draw, year, round(score_current, 6) AS score_current FROM paths",
    "projection_improved": _with(*TO_PEERS, *_paths(3))
    + "SELECT country, draw, year, round(score_improved, 6) AS score_improved FROM paths",
    "projection_many": _with(
        """scores AS (
  SELECT s_suppkey::VARCHAR AS country, s_nationkey,
         (s_acctbal - min(s_acctbal) OVER ()) / (max(s_acctbal) OVER () - min(s_acctbal) OVER ()) AS "Weighted_Score"
  FROM supplier)""",
        """pairs AS (
  SELECT country, first_value(country) OVER (PARTITION BY s_nationkey ORDER BY "Weighted_Score" DESC, country DESC) AS peer
  FROM scores)""",
        _peers("scores"),
        *_paths(1),
    )
    + """SELECT country, peer, year, round(score_current, 6) AS score_current,
  round(score_improved, 6) AS score_improved FROM paths""",
    "projection_explanation": _with(*TO_PEERS, NAMES)
    + f"""SELECT country, coalesce(other.name, peer) AS top_country,
  coalesce(own.name, country) || ' is compared to ' || coalesce(other.name, peer) || ', a country with a comparable economic footprint (GDP) but stronger EU participation metrics. The simulation projects how ' || coalesce(own.name, country) || '''s performance would evolve if it progressively adopted 85% of ' || coalesce(other.name, peer) || '''s participation metrics across collaboration, project density, and funding absorption. Global events like the {', '.join(f'{y} – {s}' for y, s in PROJECTION_SHOCKS.items())} are modeled to induce plausible setbacks. This scenario helps gauge feasibility and impact toward 2050 EU cohesion goals.' AS explanation,
  {SUMMARY} FROM peers {PATH_NAMES}""",
    "projection_report": _with(*TO_PATHS, NAMES)
    + f"""SELECT country, string_agg(year::VARCHAR, ',' ORDER BY year) AS years,
  string_agg(printf('%.6f', score_current), ',' ORDER BY year) AS score_current,
  string_agg(printf('%.6f', score_improved), ',' ORDER BY year) AS score_improved,
  coalesce(any_value(other.name), peer) AS top_country, {SUMMARY} FROM paths {PATH_NAMES} GROUP BY country, peer""",
    "projection_series": _with(*TO_PATHS)
    + """SELECT country, year, round(score_current, 6) AS score_current, round(score_improved, 6) AS score_improved FROM paths""",
    "projection_annotations": _with(*TO_PATHS)
    + """SELECT country, year, label, round(height, 6) AS height
FROM (SELECT country, greatest(max(score_current), max(score_improved)) AS height FROM paths GROUP BY 1),
  (VALUES (2025, 'First year'), (2030, 'Funding reduction'), (2036, 'Policy withdrawal'),
          (2043, 'Technological disruption'), (2050, 'Last year')) shocks(year, label)""",
    "csv_roundtrip": _with(*TO_MERGED)
    + """SELECT "projectID", "organisationID", "order", country, ec AS "ecContribution", status, topics,
  CASE WHEN country <> 'NATION_5' THEN country END AS code, objective FROM merged""",
    "parquet_roundtrip": _with(*TO_SCORED) + f"SELECT {FEATURE_COLUMNS} FROM scored",
    "json_artifact_roundtrip": _with(*TO_WEIGHTED)
    + """SELECT country, round("Weighted_Score", 6) AS "Weighted_Score", round(ramp, 6) AS ramp, is_average FROM weighted""",
    "json_records": f"""SELECT {LINE_KEYS}, 'price' AS kind, l_extendedprice AS amount FROM lineitem
UNION ALL SELECT {LINE_KEYS}, 'quantity', l_quantity FROM lineitem""",
    "json_columns": f"""SELECT {LINE_KEYS}, 'discount' AS feature, l_discount AS importance FROM lineitem
UNION ALL SELECT {LINE_KEYS}, 'tax', l_tax FROM lineitem""",
    "json_map_explode": "SELECT doc_id::VARCHAR AS project_id, unnest(string_split(text, '. ')) AS term FROM documents",
    "unique_texts_by_position": """SELECT source || '/' || lang AS key, arg_min(text, md5(doc_id::VARCHAR)) AS text
FROM documents WHERE text IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "approx_unique_orgs": _with(*TO_MERGED)
    + """SELECT country, count(DISTINCT "organisationID") AS unique_orgs, true AS within_bound, true AS slices_equal_whole FROM merged GROUP BY 1""",
    "bitmap_features": _with(*TO_MERGED, COLLAB, GROUPED)
    + """SELECT country, round(total_ec_contribution, 2) AS total_ec_contribution, total_projects, unique_orgs,
  round(collab_project_ratio, 6) AS collab_project_ratio, round(signed_pct, 6) AS signed_pct, round(closed_pct, 6) AS closed_pct,
  round(terminated_pct, 6) AS terminated_pct, round(signed_pct + closed_pct - terminated_pct, 6) AS success_ratio FROM grouped""",
    "bitmap_merge": _with(*TO_MERGED)
    + """SELECT country, count(DISTINCT "projectID") AS total_projects, count(DISTINCT "organisationID") AS unique_orgs FROM merged GROUP BY 1""",
    "phrase_relevance_vectors": _with(*VECTORS)
    + """SELECT doc_id, phrase, tf, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, phrase) AS rank FROM near_phrases) WHERE rank <= 20""",
    "cluster_assignment": _with(*CENTRES)
    + """SELECT doc_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance)::DOUBLE / 1000000 AS distance FROM choices GROUP BY 1""",
    "holdout_check": _with(*ORDER_SCORES)
    + " UNION ALL ".join(
        f"""SELECT '{label}' AS label, count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test,
  round(sqrt(avg(power("{label}" - (SELECT avg("{label}") FROM orders_scored WHERE NOT is_test), 2)) FILTER (is_test)), 6) AS mean_error,
  true AS stopped_early, true AS beats_mean FROM orders_scored"""
        for label in ("Score", "Weighted_Score")
    ),
    "permutation_importance": _with(
        *ORDER_SCORES,
        "cells AS ("
        + " UNION ALL ".join(
            f"""SELECT order_id, "Score", "Weighted_Score", '{m}_scaled' AS feature, {m}_scaled AS value, {w}::DOUBLE AS weight FROM orders_scored WHERE is_test"""
            for m, w in ORDER_WEIGHTS.items()
        )
        + ")",
        """dealt AS (
  SELECT *, coalesce(lead(value) OVER o, first_value(value) OVER o) AS other FROM cells
  WINDOW o AS (PARTITION BY feature ORDER BY md5(order_id || '|' || feature || '|42'), order_id))""",
        """errors AS (
  SELECT feature, avg(power("Score" - "Weighted_Score", 2)) AS base_error,
         avg(power("Score" - "Weighted_Score" - weight * (other - value), 2)) AS permuted_error FROM dealt GROUP BY 1)""",
    )
    + """SELECT feature, round(base_error, 9) AS base_error, round(permuted_error, 9) AS permuted_error,
  round(permuted_error - base_error, 9) AS importance FROM errors""",
    "csv_single_file": """SELECT doc_id, 'He said "a,b"' || chr(10) || chr(10) || text AS text FROM documents""",
    "json_single_document": "SELECT doc_id, text, source FROM documents",
    "merge_projects_bucketed": _with(*TO_MERGED)
    + """SELECT "projectID", "organisationID", country, "order", round(ec, 4) AS "ecContribution", topics, status FROM merged""",
}
