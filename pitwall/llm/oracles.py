"""SQL twins of the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS gram
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b
            WHERE len(w) > 0)),
h AS (SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram
      FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s
            FROM d, (SELECT DISTINCT n FROM g))),
m AS (SELECT h.rid, h.s, h.n, g.item_id FROM h JOIN g ON h.gram = g.gram AND h.n = g.n),
p AS (SELECT rid, count(DISTINCT p) AS n_hit
      FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM m))
      GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items,
             string_agg(item, ',' ORDER BY item COLLATE "binary") AS items
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN i USING (rid)"""

# The dated list that the query derives from the pages themselves; see queries.url_entries.
_HOST = r"""lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1))"""
_PATH = r"""regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1)"""

URL_FILTERS = f"""
WITH c AS (SELECT page_id, url, {_HOST} AS host,
                  list_filter(regexp_split_to_array({_PATH}, '/+'), lambda x: x <> '') AS segments,
                  DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched
           FROM pages),
h AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS v
      FROM c WHERE host <> ''),
k AS (SELECT DISTINCT host || '/' || segments[1] AS pattern FROM c
      WHERE host <> '' AND len(segments) > 0),
o AS (SELECT DISTINCT regexp_replace(host, '^[^.]*[.]', '') AS pattern FROM h WHERE host LIKE '%.%'),
e AS (SELECT host AS pattern, 'block' AS action, CAST(v % 300 AS INTEGER) AS day FROM h WHERE v % 3 = 0
      UNION ALL
      SELECT host, 'remove', CAST(v % 300 + 10 + v % 60 AS INTEGER) FROM h WHERE v % 6 = 0
      UNION ALL
      SELECT host, 'block', CAST(v % 300 + 90 AS INTEGER) FROM h WHERE v % 12 = 0
      UNION ALL
      SELECT pattern, 'allow', CAST(v % 350 AS INTEGER)
      FROM (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS v FROM k)
      WHERE v % 4 = 1
      UNION ALL
      SELECT pattern, 'block', CAST(v % 350 AS INTEGER)
      FROM (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS v FROM o)
      WHERE v % 5 = 0),
r AS (SELECT pattern, day, max(CASE action WHEN 'allow' THEN 3 WHEN 'block' THEN 2 ELSE 1 END) AS k
      FROM e GROUP BY pattern, day),
t AS (SELECT pattern, k, DATE '2024-01-01' + day AS valid_from,
             coalesce(lead(DATE '2024-01-01' + day) OVER (PARTITION BY pattern ORDER BY day),
                      DATE '9999-12-31') AS valid_to
      FROM r),
q AS (SELECT c.page_id, c.url, c.host, c.fetched, t.pattern, t.k, t.valid_from, t.valid_to,
             row_number() OVER (PARTITION BY c.page_id, c.url
                                ORDER BY length(t.pattern) DESC, t.pattern DESC) AS rn
      FROM c LEFT JOIN t
        ON (c.host = t.pattern OR ends_with(c.host, '.' || t.pattern)
            OR t.pattern = c.host || '/' || c.segments[1])
       AND t.k > 1 AND c.fetched >= t.valid_from AND c.fetched < t.valid_to)
SELECT page_id, url, nullif(host, '') AS host, fetched,
       CASE k WHEN 3 THEN 'allow' WHEN 2 THEN 'block' ELSE 'none' END AS verdict,
       pattern, valid_from, valid_to
FROM q WHERE rn = 1"""

_TERMS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

SOURCE_DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS whole FROM t GROUP BY lang, term
      HAVING count(DISTINCT rid) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term)
      GROUP BY t.lang, t.source, t.term),
f AS (SELECT g.lang, g.source, k.term, k.whole, coalesce(c.n, 0) AS n
      FROM g JOIN k ON g.lang = k.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n,
             CAST(1 + 1000000000 * (n + 1) // (sum(n) OVER s + count(*) OVER s) AS BIGINT) AS p,
             CAST(1 + 1000000000 * (whole + 1) // (sum(whole) OVER s + count(*) OVER s) AS BIGINT)
               AS q
      FROM f WINDOW s AS (PARTITION BY lang, source)),
x AS (SELECT a.lang, a.source, b.source AS item,
             CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
                                        ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM r
WHERE part = 'pair' OR rank <= 200"""
