"""DuckDB SQL of the numbered queries that SQL can express."""

from __future__ import annotations

ORACLE = {
    "op1_mixing": r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '~') AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT k, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY k
), f AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size / w, k
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY source_size / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM s
), l AS (
  SELECT *, greatest(budget - before, 0)::DOUBLE / rest AS level FROM f
), t AS (
  SELECT k, source_size,
         CASE WHEN level * w < cap THEN w * max(CASE WHEN level * w < cap THEN level END) OVER () ELSE cap END AS target
  FROM l
), r AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS ratio,
         ('0x' || substr(sha256('mix-1' || k), 1, 12))::BIGINT::DOUBLE / 281474976710656::DOUBLE AS u,
         row_number() OVER (PARTITION BY k ORDER BY size, ((coalesce(doc_id, 0) % 1024) + 1024) % 1024, doc_id) AS i
  FROM d JOIN t USING (k)
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * least(floor(i * ratio + u) - floor((i - 1) * ratio + u), 2))::BIGINT AS taken
FROM r
""",
    "op2_topk": """
WITH e AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v::DOUBLE[], e.v::DOUBLE[])::BIGINT AS score
  FROM e q JOIN e ON q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM p WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20
""",
    "op3_warc": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
""",
    "op5_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
""",
    "op11_ranked": r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), d AS (
  SELECT row, doc_id, len(terms)::BIGINT AS n FROM t WHERE len(terms) > 0
), c AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM d
), p AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM t) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, c GROUP BY term, docs
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), s AS (
  SELECT item_id, doc_id, row,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (row), c
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER o)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 50
""",
}
