"""DuckDB SQL of the queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {}

ORACLE["op6_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
"""

# CRC-32 bit by bit (3988292384 is its reversed polynomial, a fixed value); trees and climbs as recursive queries.
ORACLE["op13_merkle"] = """
WITH RECURSIVE bits AS (
  SELECT doc_id, source, lang, n_chars, text, (list_reduce(list_prepend(4294967295::UBIGINT,
     [ord(c)::UBIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
     lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)::UBIGINT[]),
       lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))) AS crc
  FROM documents
), changed AS (
  SELECT doc_id, source, lang, n_chars, text,
    CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295::UBIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other
  FROM bits
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS folded
  FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
     || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM changed)
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, folded) - 1 AS pos
  FROM leaves
), below AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (max(size) + 2) // 3
  FROM below WHERE size > 1 GROUP BY tree, level, pos // 3
), tops AS (SELECT tree, level, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM below WHERE size = 1
), above AS (
  SELECT 0 AS tree, 0 AS level, pos, digest, count(*) OVER () AS size FROM tops
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (max(size) + 2) // 3
  FROM above WHERE size > 1 GROUP BY tree, level, pos // 3
), nodes AS (
  SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS children FROM below WHERE size > 1 GROUP BY ALL
  UNION ALL
  SELECT 0, level, pos // 3, list(digest ORDER BY pos) FROM above WHERE size > 1 GROUP BY ALL
), climb AS (
  SELECT doc_id, leaf, tree AS own, tree, 0 AS level, pos, folded, '' AS siblings FROM placed
  UNION ALL
  SELECT c.doc_id, c.leaf, c.own, coalesce(n.tree, 0), CASE WHEN n.tree IS NULL THEN 0 ELSE c.level + 1 END,
         CASE WHEN n.tree IS NULL THEN t.pos ELSE c.pos // 3 END,
         CASE WHEN n.tree IS NULL THEN c.folded
              ELSE sha256(array_to_string([CASE WHEN i - 1 = c.pos % 3 THEN c.folded ELSE d END FOR d, i IN n.children], '')) END,
         c.siblings || coalesce(array_to_string([d FOR d, i IN n.children IF i - 1 <> c.pos % 3], ''), '')
  FROM climb c LEFT JOIN nodes n ON n.tree = c.tree AND n.level = c.level AND n.run = c.pos // 3
  LEFT JOIN tops t ON t.tree = c.tree AND n.tree IS NULL
  WHERE c.tree > 0 OR n.tree IS NOT NULL
), ends AS (
  SELECT c.* FROM climb c JOIN above a ON c.tree = 0 AND c.level = a.level AND a.size = 1
)
SELECT e.doc_id, e.leaf, t.digest AS subroot, r.digest AS root, sha256(e.siblings) AS proof_sha256, e.folded AS folded_root,
       e.folded = r.digest AS verified
FROM ends e JOIN tops t ON t.tree = e.own JOIN (SELECT digest FROM above WHERE size = 1) r ON TRUE
"""

ORACLE["op11_cover_tree"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(b) FROM reached WHERE a = vec_id), vec_id)) AS component_id,
       least(vec_id, coalesce((SELECT min(b) FROM reached WHERE a = vec_id), vec_id)) = vec_id AS kept
FROM embeddings
"""
