"""The corpus queries in SQL, where SQL can say them."""

from __future__ import annotations

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_BLANK}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY 1) m ON m.a = d.doc_id
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP4 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_ALNUM}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_FOLDED}, '{_ALNUM}') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, greatest(len(w) - 11, 2)), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM i WHERE len(w) > 0),
z AS (SELECT DISTINCT n FROM g),
x AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS k FROM d, z)),
h AS (SELECT doc_id, x.n, k, item_id FROM x JOIN g ON g.n = x.n AND g.g = x.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS s FROM h GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS w FROM documents),
x AS (SELECT doc_id, k, array_to_string(w[k:k + 34], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS k FROM d)),
r AS (SELECT g FROM x GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(k, k + 35)) AS p FROM x JOIN r USING (g)) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
sha256(coalesce(array_to_string(list_filter(w, lambda t, i: gone IS NULL OR NOT list_contains(gone, i)), ' '), '')) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id)
"""

_SEPARATED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CRC = """
c AS (SELECT list(c ORDER BY b) AS crc FROM (SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) t(b)))"""

OP11 = rf"""
WITH {_CRC.strip()},
d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_SEPARATED}') AS w FROM documents),
i AS (SELECT regexp_extract_all({_FOLDED}, '{_SEPARATED}') AS w FROM benchmark),
x AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: array_to_string(w[k:k + 1], ' ')), list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' ')))) AS g FROM (SELECT doc_id, w FROM d UNION ALL SELECT NULL, w FROM i)),
y AS (SELECT doc_id, g, count(*) AS n FROM x GROUP BY 1, 2),
h AS (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(g)), lambda k: CAST('0x' || substr(hex(encode(g)), 2 * k + 1, 2) AS BIGINT))), lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS b FROM (SELECT DISTINCT g FROM y), c),
z AS (SELECT doc_id, b, sum(n) AS n FROM y JOIN h USING (g) GROUP BY 1, 2),
s AS (SELECT b, CAST(sum(n) FILTER (doc_id IS NOT NULL) AS DOUBLE) AS s, CAST(sum(n) FILTER (doc_id IS NULL) AS DOUBLE) AS t FROM z GROUP BY 1),
g AS (SELECT b, floor(CAST(1000 AS DOUBLE) * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT sum(t) FROM s) + 10000)))) AS gain FROM s),
m AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM z JOIN g USING (b) WHERE doc_id IS NOT NULL GROUP BY 1),
v AS (SELECT doc_id, len(w) >= 20 AS may, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(CAST(-1000 AS DOUBLE) * ln(-ln((CAST(CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN m USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS k, count(*) FILTER (may) OVER () AS n FROM v)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND k <= 5 * n // 100 THEN k END AS rank FROM r
"""

OP12 = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT doc_id, l, list_transform(l, lambda x: translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS k FROM l),
c AS (SELECT k FROM (SELECT doc_id, unnest(k) AS k FROM k) WHERE length(k) >= 1 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 10),
s AS (SELECT coalesce(list(k), []) AS c FROM c),
r AS (SELECT doc_id, l, list_filter(l, lambda x, i: NOT list_contains(c, k[i])) AS r FROM k, s)
SELECT doc_id, len(l) AS n_lines, len(l) - len(r) AS n_dropped, sha256(coalesce(array_to_string(r, chr(10)), '')) AS kept_sha256 FROM r
"""

OP13 = rf"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all({_FOLDED}, '{_SEPARATED}')) AS t FROM documents),
f AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY 1, 2),
z AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY 1),
a AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM z),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, a GROUP BY t, nd),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED}, '{_SEPARATED}')) AS t FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l)))) AS BIGINT) AS score FROM q JOIN f USING (t) JOIN w USING (t) JOIN z USING (doc_id), a GROUP BY 1, 2),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""

SQL = {"op2_ngram_join": OP2, "op4_benchmark_decontamination": OP4, "op7_topk_search": OP7, "op10_substring_dedup": OP10, "op11_target_resampling": OP11, "op12_line_dedup": OP12, "op13_ranked_search": OP13}
