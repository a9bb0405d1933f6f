"""DuckDB SQL with the same results as the operators' queries."""

WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"

OP5_EXACT_DEDUP = """
SELECT doc_id, keep_id, coalesce(doc_id <> keep_id, false) AS is_duplicate
FROM (SELECT doc_id, CASE WHEN text IS NULL OR doc_id IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS keep_id FROM documents)
"""

#: pieces is 1 for rates up to 32; higher rates are drawn in several pieces of equal mean.
MIX = """
n AS (SELECT source, count(*) AS n_docs FROM {docs} GROUP BY source),
w AS (SELECT source, n_docs, sqrt(n_docs::DOUBLE) / sum(sqrt(n_docs::DOUBLE)) OVER () AS weight, sum(n_docs) OVER () AS total FROM n),
r AS (SELECT source, weight * total / n_docs AS rate, greatest(1, ceil(weight * total / n_docs / 32))::INT AS pieces FROM w),
terms AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM (SELECT source, k, exp(k * ln(rate / pieces) - rate / pieces - lgamma(k + 1)) AS p FROM r, range(0, 121) t(k))
),
cdf AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM terms GROUP BY source),
draws AS (
  SELECT d.doc_id, d.source, coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, ''))) AS who, {text} r.pieces, c.cdf
  FROM {docs} d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source
),
reps AS (
  SELECT doc_id, source, {texts} list_sum(list_transform(range(1, pieces + 1), lambda i:
    len(list_filter(cdf, lambda x: x <= ('0x' || substr(md5('20|' || who || '|' || i), 1, 13))::BIGINT / 4503599627370496.0)))) AS reps
  FROM draws
)
"""
OP1_MIX = "WITH " + MIX.format(docs="documents", text="d.text,", texts="text,") + "SELECT doc_id, source, text, unnest(range(0, reps::BIGINT))::INT AS copy FROM reps"


def op6_urls(rules: dict[str, str]) -> str:
    quoted = ", ".join("('{}', '{}')".format(n.replace("'", "''"), g.replace("'", "''")) for n, g in rules.items())
    scheme = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)"
    return rf"""
WITH u AS (SELECT page_id, regexp_replace(trim(url), '#[\s\S]*$', '') AS u, row_number() OVER () AS row FROM pages),
parts AS (
  SELECT *, lower(regexp_extract(u, '{scheme}', 1)) AS scheme, lower(regexp_extract(u, '{scheme}', 2)) AS host, regexp_replace(regexp_extract(u, '{scheme}', 3), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(u, '\?([\s\S]*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params
  FROM u
),
c AS (
  SELECT row, page_id, CASE WHEN scheme = '' THEN u ELSE scheme || '://' || regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)$', ''), '^www\.', '') || path
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical_url
  FROM parts
),
rules(name, pat) AS (VALUES {quoted})
SELECT any_value(page_id) AS page_id, any_value(canonical_url) AS canonical_url, coalesce(list_sort(list(name) FILTER (name IS NOT NULL)), []) AS rules, count(name) > 0 AS blocked
FROM c LEFT JOIN rules ON canonical_url GLOB pat GROUP BY row
"""


OP10_TOP_K = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
s AS (SELECT a.vec_id, b.vec_id AS neighbour_id, round(list_inner_product(a.v, b.v), 9) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour_id)::INT AS rank FROM s)
SELECT vec_id, rank, neighbour_id, score FROM r WHERE rank <= 10
"""


OP3_SUBSTRING = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
win AS (SELECT doc_id, pos, array_to_string(w[pos + 1 : pos + 50], ' ') AS t FROM d, unnest(range(0, greatest(len(w) - 49, 0))) u(pos)),
c AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY t) AS n, row_number() OVER (PARTITION BY t ORDER BY doc_id, pos) AS r FROM win),
k AS (SELECT doc_id, 0 AS kind, pos FROM c WHERE n > 1 UNION ALL SELECT doc_id, 1 AS kind, pos FROM c WHERE r > 1),
o AS (SELECT *, (pos > coalesce(lag(pos) OVER (PARTITION BY doc_id, kind ORDER BY pos) + 50, -1))::INT AS open FROM k),
i AS (SELECT *, sum(open) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS island FROM o),
s AS (SELECT doc_id, kind, min(pos) AS a, max(pos) + 50 AS b FROM i GROUP BY doc_id, kind, island)
SELECT doc_id, coalesce(string_agg(a || '-' || b, ' ' ORDER BY a) FILTER (kind = 0), '') AS spans, coalesce(sum(b - a) FILTER (kind = 0), 0)::BIGINT AS repeated_words,
  coalesce(string_agg(a || '-' || b, ' ' ORDER BY a) FILTER (kind = 1), '') AS cut_spans, coalesce(sum(b - a) FILTER (kind = 1), 0)::BIGINT AS cut_words
FROM s GROUP BY doc_id
"""


OP2_NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
m AS (SELECT DISTINCT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS grams FROM d WHERE len(w) > 0),
c AS (SELECT row_number() OVER () AS node, grams, len(grams) AS n, min(doc_id) AS lead, count(*) AS members FROM m GROUP BY grams),
g AS (SELECT node, n, unnest(grams) AS gram FROM c),
p AS (SELECT a.node AS x, b.node AS y, count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) AS jaccard FROM g a JOIN g b ON a.gram = b.gram AND a.node < b.node GROUP BY a.node, b.node),
e AS (SELECT x, y, jaccard FROM p WHERE jaccard >= 0.55 - 1e-9 UNION ALL SELECT y, x, jaccard FROM p WHERE jaccard >= 0.55 - 1e-9),
reach(node, other) AS (SELECT node, node FROM c UNION SELECT r.node, e.y FROM reach r JOIN e ON r.other = e.x),
class AS (SELECT r.node, min(c.lead) AS class_id FROM reach r JOIN c ON r.other = c.node GROUP BY r.node),
links AS (SELECT e.x AS node, sum(c.members) AS links, max(e.jaccard) AS best FROM e JOIN c ON e.y = c.node GROUP BY e.x)
SELECT m.doc_id, class.class_id, (c.members - 1 + coalesce(links.links, 0))::BIGINT AS n_links, CASE WHEN c.members > 1 THEN 1.0::DOUBLE ELSE links.best END AS nearest
FROM m JOIN c ON m.grams = c.grams JOIN class ON class.node = c.node LEFT JOIN links ON links.node = c.node
UNION ALL SELECT DISTINCT doc_id, doc_id, 0::BIGINT, NULL::DOUBLE FROM d WHERE len(w) = 0
"""
