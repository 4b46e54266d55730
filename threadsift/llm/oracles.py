"""DuckDB SQL that gives the rows of the queries which SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"'[^\x20\x09-\x0D]+'"

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
 FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON b.g = a.g AND b.doc_id <> a.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, top) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.top FROM r JOIN l ON l.b = r.doc_id)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.top) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM windows) x WHERE c > 1),
words AS (SELECT doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
judged AS (SELECT w.doc_id, w.i, w.word, coalesce(w.i - max(r.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) < 35, FALSE) AS gone
 FROM words w LEFT JOIN repeated r ON r.doc_id = w.doc_id AND r.i = w.i)
SELECT d.doc_id, count(j.i) AS n_words, count(j.i) FILTER (WHERE gone) AS n_removed,
 sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id"""
