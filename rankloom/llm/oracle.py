"""SQL for the queries that SQL can express, over the tables as views."""

from __future__ import annotations

NEAR_DUPLICATES = r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM parts),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
ends AS (SELECT p, q FROM links UNION ALL SELECT q, p FROM links),
reached AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reached.doc_id, ends.q FROM reached JOIN ends ON reached.r = ends.p)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id) c USING (doc_id)"""

SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
  SELECT doc_id, p, md5_number(substring(h, 2 * p + 1, 200)) AS digest
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM texts WHERE length(h) >= 200)),
numbered AS (SELECT doc_id, p, row_number() OVER (PARTITION BY digest ORDER BY doc_id, p) AS k FROM places),
repeats AS (SELECT doc_id, p, p > lag(p, 1, -101) OVER (PARTITION BY doc_id ORDER BY p) + 100 AS opens FROM numbered WHERE k > 1),
islands AS (SELECT doc_id, p, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM repeats),
spans AS (SELECT doc_id, island, min(p) AS a, max(p) + 100 AS z FROM islands GROUP BY doc_id, island),
pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
  UNION ALL SELECT t.doc_id, s.z, length(t.h) // 2 FROM texts t JOIN (SELECT doc_id, max(z) AS z FROM spans GROUP BY doc_id) s USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substring(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (z - a) AS BIGINT)), '' ORDER BY a) AS h FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id),
lost AS (SELECT doc_id, sum(z - a) AS n, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(l.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(l.spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN lost l USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

EXACT_DEDUP = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY t)
SELECT f.doc_id, g.keep_id, g.group_size, f.doc_id = g.keep_id AS kept, sha256(f.t) AS text_sha256
FROM folded f JOIN groups g ON f.t = g.t"""

#: Each document's failed filters as a word, each order as a word: a step removes what fails its letter and none before it.
FILTER_AUDIT = r"""
WITH RECURSIVE labelled AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
failed AS (
  SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(x.t, '[^A-Z]+', '', 'g')) > 2 * length(x.t) AS c,
    regexp_matches(x.t, '[#$%&*|]') AS d, x.doc_id > f.first_id AS e
  FROM texts x JOIN firsts f ON x.t = f.t LEFT JOIN labelled l ON x.doc_id = l.doc_id),
masks AS (
  SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
    CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS m, count(*) AS n,
    count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT '' AS o UNION ALL SELECT o || f FROM orders, letters WHERE NOT contains(o, f)),
steps AS (
  SELECT o AS filter_order, s AS step, o[s] AS filter, o[:s - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s) WHERE length(o) = 5),
met AS (
  SELECT *, translate(m, before, '') = m AS arrives, contains(m, filter) AS fails FROM masks, steps),
found AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (arrives), 0) AS reached,
    coalesce(sum(n) FILTER (arrives AND fails), 0) AS removed,
    coalesce(sum(n) FILTER (fails), 0) AS failing,
    coalesce(sum(n) FILTER (m = filter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (arrives AND fails), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (arrives AND fails), 0) AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, CAST(reached - removed AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(failing - removed AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM found"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
per_doc AS (SELECT lang, source, unnest(list_distinct(w)) AS term FROM docs),
terms AS (SELECT lang, term FROM per_doc GROUP BY ALL HAVING count(*) >= 10),
found AS (SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(w) AS term FROM docs) SEMI JOIN terms USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM terms GROUP BY lang),
grid AS (SELECT g.lang, g.source, t.term, coalesce(f.c, 0) AS c FROM groups g JOIN terms t USING (lang) LEFT JOIN found f USING (lang, source, term)),
whole AS (SELECT lang, term, sum(c) AS c FROM grid GROUP BY ALL),
p AS (
  SELECT lang, source, term, c, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p
  FROM grid JOIN sizes USING (lang)),
q AS (
  SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q
  FROM whole JOIN sizes USING (lang)),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
telling AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value,
    row_number() OVER (PARTITION BY lang, source ORDER BY ((p - q) * (p - q)) // (p + q) DESC, term) AS k
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(k AS INTEGER) FROM telling WHERE k <= 10"""

ORACLE = {"op7_near_duplicates": NEAR_DUPLICATES, "op2_suffix_dedup": SUFFIX_DEDUP, "op12_exact_dedup": EXACT_DEDUP, "op11_filter_audit": FILTER_AUDIT, "op13_source_divergence": SOURCE_DIVERGENCE}
