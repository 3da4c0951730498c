"""SQL equivalents, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

# The mix: weights of the sources in turn, the most passes over one, the seed of its order.
WEIGHTS, MAX_PASSES, SEED = (1, 2, 3), 3, 17

OP2 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY h)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, h AS text_sha256
FROM d JOIN g USING (h)
"""

OP3 = rf"""
WITH d AS (
  SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS src,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS place
  FROM documents),
g AS (SELECT no_source, src, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
s AS (
  SELECT *,
    [{", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)}][
      1 + (row_number() OVER (ORDER BY no_source, src) - 1) % {len(WEIGHTS)}] AS weight
  FROM g),
l AS (
  SELECT *, source_size * {MAX_PASSES} AS bound, source_size * {MAX_PASSES} / weight AS ratio FROM s),
v AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY ratio, no_source, src
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, no_source, src
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM l),
f AS (
  SELECT level AS factor FROM v WHERE level <= ratio ORDER BY ratio, no_source, src LIMIT 1),
t AS (
  SELECT no_source, src, source_size,
    CASE WHEN level <= ratio THEN least(factor * weight, bound::DOUBLE) ELSE bound::DOUBLE END AS target
  FROM v, f),
q AS (
  SELECT d.*, source_size, target,
    sum(size) OVER (PARTITION BY d.no_source, d.src ORDER BY place, doc_id, size
      ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.no_source = t.no_source AND d.src = t.src),
p AS (
  SELECT q.*, (pass * source_size + upto)::DOUBLE / target AS finish
  FROM q, range({MAX_PASSES}) AS r(pass) WHERE size > 0 AND target > 0),
c AS (
  SELECT *, sum(size) OVER (ORDER BY finish, no_source, src, place, doc_id, size
    ROWS UNBOUNDED PRECEDING) AS words FROM p),
k AS (
  SELECT doc_id, count(*) AS copies FROM c
  WHERE words <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, size::BIGINT AS size, source_size, target,
  (coalesce(copies, 0) * size)::BIGINT AS taken
FROM q LEFT JOIN k ON q.doc_id = k.doc_id
"""



def _clustering(rounds: int = 5) -> str:
    """Centroids of every round as CTEs c0, c1, ..."""
    nearest = """
a{r} AS MATERIALIZED (
  SELECT n, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT n, cluster, list_sum(list_transform(list_zip(v, c),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM k, c{r})
  GROUP BY n)"""
    moved = """
s{r} AS MATERIALIZED (
  SELECT cluster, i, floor(sum(v[i])::DECIMAL(38, 0) / count(*))::BIGINT AS x
  FROM k JOIN a{r} USING (n), range(1, 65) AS p(i) GROUP BY ALL),
c{next} AS MATERIALIZED (
  SELECT c{r}.cluster, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster, list(x ORDER BY i) AS c FROM s{r} GROUP BY ALL) AS m USING (cluster))"""
    parts = []
    for r in range(rounds):
        parts += [nearest.format(r=r), moved.format(r=r, next=r + 1)]
    parts.append(nearest.format(r=rounds))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v AS c FROM (
    SELECT sha256('2:' || vec_id::VARCHAR) AS h, v FROM k ORDER BY h, v LIMIT 40)),
{",".join(parts)}
SELECT vec_id, a.cluster::INTEGER AS cluster, distance,
  (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM k JOIN a{rounds} AS a USING (n) JOIN c{rounds} AS f ON f.cluster = a.cluster
"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id,
    regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0),
t AS MATERIALIZED (
  SELECT n, i, m, array_to_string(w[i:i + m - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT m FROM g), LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i) WHERE len(w) >= m),
f AS MATERIALIZED (SELECT n, i, m, item FROM t JOIN g USING (m, gram)),
h AS (
  SELECT n, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT n, i, m FROM f), LATERAL (SELECT unnest(range(i, i + m)) AS j) GROUP BY n),
s AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT n, item FROM f) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (n) LEFT JOIN s USING (n)
"""

OP13 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, w, len(w) AS n FROM (
    SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents) WHERE len(w) > 0),
z AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM d),
q AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS MATERIALIZED (
  SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
  FROM p, z GROUP BY term, docs),
s AS (
  SELECT item_id, k, sum(weight * ((1000000000 * tf) // (1000 * tf
    + 20 * (100 - 50 + ((50 * n * docs) // length)))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN f USING (term) JOIN d USING (k), z GROUP BY ALL),
r AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s JOIN d USING (k) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""

SQL = {
    "op2_exact_dedup": OP2,
    "op3_mixing": OP3,
    "op11_centroids": _clustering(),
    "op12_winnowing": OP12,
    "op13_nra_search": OP13,
}
