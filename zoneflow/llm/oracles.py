"""DuckDB SQL for the queries that SQL can express; values are written out here on their own."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_warc_merkle_audit"] = r"""
WITH p AS (
  SELECT page_id, CAST(floor(page_id / 2000.0) AS BIGINT) AS segment, coalesce(url, '') AS url,
         coalesce(html, '') AS html FROM pages),
d AS (
  SELECT *, CASE WHEN page_id % 101 = 7 AND length(html) > 0
                 THEN left(html, length(html) - 1) || CASE WHEN html LIKE '%~' THEN '!' ELSE '~' END
                 ELSE html END AS html2 FROM p),
r AS (
  SELECT page_id, segment, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
         || 'WARC-Date: 2020-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: '
         || translate(url, chr(13) || chr(10), '  ') || chr(13) || chr(10)
         || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' AS head, html, html2 FROM d),
f AS (
  SELECT page_id, segment, head || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html AS a,
         head || strlen(html2) || chr(13) || chr(10) || chr(13) || chr(10) || html2 AS b FROM r),
w AS (
  SELECT page_id, segment, row_number() OVER o - 1 AS position,
         CAST(coalesce(sum(strlen(a) + 4) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
         strlen(a) AS length, sha256(a) AS digest_first, sha256(b) AS digest_second
  FROM f WINDOW o AS (PARTITION BY segment ORDER BY page_id))
SELECT page_id, segment, position, "offset", length, digest_first, digest_second, 'changed' AS status
FROM w WHERE digest_first <> digest_second
"""

ORACLES["op7_url_rules"] = r"""
WITH a AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM b)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN host || path LIKE '%/ads/%' OR host || path LIKE '%/login%' OR host || path LIKE '%.exe' THEN 'block'
  ELSE 'allow' END AS verdict FROM c
"""

# the crc32 of "<doc_id>:<word>" is folded over its UTF-8 bytes; near words share a form with one code point left out
ORACLES["op13_qchunk_spelling"] = r"""
WITH RECURSIVE steps AS (
  SELECT c AS byte, c AS r, 0 AS k FROM range(256) t(c)
  UNION ALL
  SELECT byte, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(r ORDER BY byte) AS tab FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 7
  GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
    string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                   ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END))),
    lambda s, b: xor(s >> 8, tab[(xor(s, b) & 255) + 1]))) AS h FROM runs, crc),
made AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (
  SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS part, i FROM (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.part = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.part = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS near_n, min_by(near, (-near_n, near)) AS near FROM pairs GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, word AS root, 0 AS steps FROM found
  UNION ALL
  SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN found f ON c.root = f.word WHERE f.form IS NOT NULL),
last AS (SELECT word, max_by(root, steps) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, l.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM found f JOIN last l ON f.word = l.word
"""

ORACLES["op12_int8_near_vectors"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, len(embedding) AS dim,
         coalesce(label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS fine FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.dim = b.dim AND a.vec_id <> b.vec_id
  WHERE a.fine AND b.fine
    AND list_dot_product(a.e, b.e) >= 0.98 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
reach AS (
  SELECT vec_id, vec_id AS there FROM v
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.there = l.a),
least AS (SELECT vec_id, min(there) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(c.n_links, 0) AS BIGINT) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM v JOIN least l ON v.vec_id = l.vec_id LEFT JOIN counts c ON v.vec_id = c.vec_id
"""
