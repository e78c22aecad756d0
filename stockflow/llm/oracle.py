"""DuckDB SQL for the queries that SQL can express."""

BYTE_SHARDS = """
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, md5(coalesce(text, '')) AS content,
       xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
         lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM documents, tab),
p AS (SELECT *, sum(size) OVER (ORDER BY content, doc_id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM d),
s AS (SELECT *, CAST(((2 * upto - size) * 8) // (2 * total) AS INTEGER) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY content, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
  AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * k >= 85 * (n + m - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept FROM s JOIN m USING (doc_id)"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

PERIODIC_RUNS = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
       xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'),
         lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1]))) AS h FROM documents, tab),
g AS (SELECT doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AS loops, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(list_transform(range(n), lambda i: CASE WHEN loops AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END)) AS w FROM p),
f AS (SELECT doc_id, n, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS five
  FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT b.doc_id, b.i, b.i - a.i AS lag FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.five = b.five AND a.i < b.i AND 4 * (b.i - a.i) <= b.n),
s AS (SELECT doc_id, lag, i, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM m),
l AS (SELECT doc_id, min(i) - lag AS start, max(i) + 5 - min(i) + lag AS length, lag AS period FROM s GROUP BY doc_id, lag, island),
c AS (SELECT * FROM l WHERE length >= greatest(6, 4 * period)),
r AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c k WHERE k.doc_id = c.doc_id AND k.period < c.period AND k.start <= c.start
  AND k.start + k.length >= c.start + c.length)),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
lines AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS s FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
  sha256(coalesce(lines.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept USING (doc_id)"""

CONTAMINATED = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS k, unnest(list_transform(range(1, greatest(len(w), 10) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
  FROM t WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
  FROM d, k WHERE len(w) >= k),
m AS (SELECT doc_id, item, i, dw.k FROM dw JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM m WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""
