"""DuckDB equivalents of the queries that SQL can state."""

from __future__ import annotations

# Sets of word shingles, all pairs that share one, exact similarity, and the smallest id that links reach.
_LINKED = """
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + least({words}, len(w)) - 1], ' ') AS s
  FROM words, unnest(range(1, CASE WHEN len(w) > 0 THEN len(w) - least({words}, len(w)) + 2 ELSE 1 END)) AS t(i)
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * k >= 80 * (x.n + y.n - k)
),
reach AS (
  SELECT r, doc_id FROM words WHERE doc_id IS NOT NULL
  UNION
  SELECT b, doc_id FROM reach JOIN links ON a = reach.r
),
least_id AS (SELECT r, min(doc_id) AS component_id FROM reach GROUP BY r)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id{more}
FROM words LEFT JOIN sizes USING (r) LEFT JOIN least_id USING (r)
"""

# The digest in base 32: four letters for every five hexadecimal digits.
_ARCHIVED = """
WITH payloads AS (SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
digests AS (
  SELECT *, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31) + 1)::INTEGER, 1)
    FOR i IN range(32)], '') AS payload_digest, min(page_id) OVER (PARTITION BY payload) AS first_id
  FROM payloads
)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
FROM digests
"""

ORACLE: dict[str, str] = {
    "op3_warc": _ARCHIVED,
    "op6_near_duplicates": _LINKED.format(words=2, more=", words.doc_id = component_id AS kept"),
    "op11_overlap_join": _LINKED.format(words=5, more=""),
    "op13_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND NOT (a.label = b.label AND a.vec_id = b.vec_id)
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
}
