"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

# Only A-Z are lower-cased.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {}

SQL["op5_norm_topk"] = """
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
  FROM whole q JOIN whole p ON q.vec_id % 20 = 0 AND p.r <> q.r
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

WORDS = "regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(lower=LOWER)

SQL["op8_fm_index"] = f"""
WITH docs AS (
  SELECT doc_id, {WORDS} AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, unnest([array_to_string(w[s:s + 9], ' ') FOR s IN range(1, greatest(len(w) - 9, 1) + 1)]) AS win,
         least(len(w), 10) AS size
  FROM items WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT size FROM windows
), runs AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS s, w FROM docs CROSS JOIN sizes WHERE len(w) >= size
), hits AS (
  SELECT r.doc_id, r.s, r.size, x.item
  FROM (SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win FROM runs) r
  JOIN windows x ON x.win = r.win AND x.size = r.size
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SQL["op10_setsketch"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[s:s + 4], ' ') FOR s IN range(1, greatest(len(w) - 4, 1) + 1)]) AS g
  FROM docs WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT c.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM component c LEFT JOIN sizes USING (doc_id)
"""
