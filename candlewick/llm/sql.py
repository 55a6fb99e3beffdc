"""DuckDB SQL for the operators that SQL can express, on the same tables."""

from __future__ import annotations

#: Words are runs of bytes other than space and tab to carriage return.
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)
), firsts AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
cov AS (
  SELECT DISTINCT doc_id, i + j AS p
  FROM win JOIN firsts USING (k), range(0, 50) r(j) WHERE least < doc_id
), u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.p) AS t
  FROM u LEFT JOIN cov ON u.doc_id = cov.doc_id AND u.p = cov.p WHERE cov.p IS NULL GROUP BY u.doc_id
), gone AS (SELECT doc_id, count(*) AS n FROM cov GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id
"""

SUFFIX_ARRAY_DEDUP = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
n AS (SELECT doc_id, t, octet_length(t) AS size FROM b),
win AS (
  SELECT doc_id, i, md5(t[i:i + 399]) AS k
  FROM (SELECT doc_id, t, unnest(range(1, size - 398)) AS i FROM n)
), twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win JOIN twice USING (k)),
edge AS (SELECT *, coalesce(i > lag(i) OVER o + 400, true) AS opens FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 400 AS z FROM run GROUP BY doc_id, r),
part AS (
  SELECT n.doc_id, coalesce(lag(z) OVER (PARTITION BY n.doc_id ORDER BY a), 1) AS lo, a AS hi, t
  FROM span JOIN n ON n.doc_id = span.doc_id
  UNION ALL
  SELECT n.doc_id, coalesce(max(z), 1), any_value(size) + 1, any_value(t)
  FROM n LEFT JOIN span ON n.doc_id = span.doc_id GROUP BY n.doc_id
), kept AS (
  SELECT doc_id, string_agg(CASE WHEN hi > lo THEN hex(t[lo:hi - 1]) ELSE '' END, '' ORDER BY lo, hi) AS h FROM part GROUP BY doc_id
), gone AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT n.doc_id, CAST(size AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM n JOIN kept ON n.doc_id = kept.doc_id LEFT JOIN gone ON n.doc_id = gone.doc_id
"""

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 90 * (x.size + y.size - m)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.size, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id
"""
