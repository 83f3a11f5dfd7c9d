"""Expected results in SQL, for the queries that SQL can express."""

#: Each pair of a query vector and another one; the rows come out in any order.
_TOP_K = """
WITH vectors AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scores
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 20
"""

#: Base 32 of the SHA-1, five bits at a time from the hex digits that hold them.
_PAGES = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digits FROM pages
),
first AS (
  SELECT payload, min(page_id) AS response FROM payloads GROUP BY payload
)
SELECT p.page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes,
  array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      ((strpos('0123456789abcdef', substr(p.digits, 1 + (5 * i) // 4, 1)) - 1) * 16
        + strpos('0123456789abcdef', substr(p.digits, 2 + (5 * i) // 4, 1)) - 1)
      // CAST(pow(2, 3 - (5 * i) % 4) AS BIGINT) % 32 AS BIGINT), 1)
    FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN f.response < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.response < p.page_id THEN f.response END AS refers_to
FROM payloads p JOIN first f ON f.payload = p.payload
"""

LLM_ORACLE_SQL = {"op8_metric_tree": _TOP_K, "op9_warc": _PAGES}
