"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source),
weighted AS (
  SELECT *, CAST([3, 1, 2][CAST((rank - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS most,
         1.5::DOUBLE * sum(source_size) OVER () AS goal
  FROM totals),
levels AS (
  SELECT a.most / a.weight AS full_at, any_value(a.goal) AS goal,
         coalesce(sum(b.most) FILTER (b.most / b.weight < a.most / a.weight), 0) AS closed,
         sum(b.weight) FILTER (b.most / b.weight >= a.most / a.weight) AS open_weight,
         sum(least(b.most, b.weight * (a.most / a.weight))) AS sent
  FROM (SELECT DISTINCT most, weight, goal FROM weighted) a, weighted b GROUP BY ALL),
level AS (
  SELECT min_by((goal - closed) / open_weight, full_at) AS level FROM levels
  WHERE sent >= goal * (1 - 1e-12)),
targets AS (SELECT w.*, least(most, weight * (SELECT level FROM level)) AS target FROM weighted w),
sent AS (
  SELECT s.*, t.rank, t.weight, t.source_size, t.goal, t.target,
         CAST(sum(size) OVER (PARTITION BY t.rank ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
queued AS (
  SELECT doc_id, rank, key, size, goal, weight, target, sent / weight AS finish FROM sent
  UNION ALL SELECT doc_id, rank, key, size, goal, weight, target, (source_size + sent) / weight FROM sent),
served AS (
  SELECT doc_id, size, goal, finish * weight - size / 2 <= target AS nearer,
         sum(size) OVER (ORDER BY finish, rank, key ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
  FROM queued),
times AS (SELECT doc_id, CAST(sum(CASE WHEN middle <= goal OR nearer THEN size ELSE 0 END) AS BIGINT) AS taken FROM served GROUP BY doc_id)
SELECT doc_id, size, source_size, target, taken FROM sent JOIN times USING (doc_id)
"""

OP8 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

OP13 = r"""
WITH found AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
held AS (SELECT doc, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM found WHERE len(terms) > 0),
every AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM held),
said AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
counts AS (
  SELECT doc, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM held)
  WHERE term IN (SELECT term FROM said) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, every GROUP BY term),
scored AS (
  SELECT item_id, doc, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // l)))) AS BIGINT) AS score
  FROM said JOIN counts USING (term) JOIN weights USING (term), every GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

CHECKS: dict[str, str] = {"op3_mixing": OP3, "op8_top_products": OP8, "op13_lexical": OP13}
