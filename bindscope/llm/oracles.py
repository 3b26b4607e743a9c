"""DuckDB SQL for the queries that SQL can state."""

#: Trees level by level; crc32 bit by bit; every leaf folded with its siblings.
MERKLE = """
WITH RECURSIVE doc AS (
  SELECT doc_id, lang, source, n_chars, text,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS m
  FROM documents
), hashed AS (
  SELECT *,
    concat(coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source)::VARCHAR || ':' || source, '-'),
      coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')) AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail
  FROM doc
), leaf AS (
  SELECT doc_id, lang, pos, m, sha256(concat(head, coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-'), tail)) AS leaf,
    sha256(concat(head, coalesce(strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR, '-'), tail)) AS grown
  FROM hashed
), tree AS (
  SELECT lang, 0 AS level, pos, m, leaf AS node FROM leaf
  UNION ALL
  SELECT lang, level + 1, pos // 2, (any_value(m) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM tree WHERE m > 1 GROUP BY lang, level, pos // 2
), subroot AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS m FROM tree WHERE m = 1
), top AS (
  SELECT 0 AS level, pos, m, subroot AS node FROM subroot
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(m) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE m > 1 GROUP BY level, pos // 2
), checksum AS (
  SELECT doc_id, lang, pos, m, leaf, grown, 0 AS k, 4294967295::UBIGINT AS c, doc_id::VARCHAR AS s FROM leaf
  UNION ALL
  SELECT doc_id, lang, pos, m, leaf, grown, k + 1,
    list_reduce([xor(c, ord(s[k + 1])::UBIGINT), 1, 2, 3, 4, 5, 6, 7, 8]::UBIGINT[], lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)), s
  FROM checksum WHERE k < length(s)
), start AS (
  SELECT doc_id, lang, pos, m, leaf, CASE WHEN xor(c, 4294967295::UBIGINT) % 7 = 0 THEN grown ELSE leaf END AS node
  FROM checksum WHERE k = coalesce(length(s), 0)
), step AS (
  SELECT doc_id, lang, leaf, 0 AS stage, 0 AS level, pos, m, node, '' AS proof FROM start
  UNION ALL
  SELECT s.doc_id, s.lang, s.leaf, CASE WHEN s.m = 1 THEN 1 ELSE s.stage END, CASE WHEN s.m = 1 THEN 0 ELSE s.level + 1 END,
    CASE WHEN s.m = 1 THEN r.pos ELSE s.pos // 2 END, CASE WHEN s.m = 1 THEN r.m ELSE (s.m + 1) // 2 END,
    CASE WHEN s.m = 1 THEN s.node WHEN s.pos % 2 = 1 THEN sha256(coalesce(t.node, u.node) || s.node) ELSE sha256(s.node || coalesce(t.node, u.node, '')) END,
    CASE WHEN s.m = 1 THEN s.proof ELSE s.proof || coalesce(t.node, u.node, '') END
  FROM step s
  LEFT JOIN tree t ON s.m > 1 AND s.stage = 0 AND t.lang IS NOT DISTINCT FROM s.lang AND t.level = s.level AND t.pos = xor(s.pos, 1)
  LEFT JOIN top u ON s.m > 1 AND s.stage = 1 AND u.level = s.level AND u.pos = xor(s.pos, 1)
  LEFT JOIN subroot r ON s.m = 1 AND r.lang IS NOT DISTINCT FROM s.lang
  WHERE s.stage = 0 OR s.m > 1
), root AS (SELECT node AS root FROM top WHERE m = 1)
SELECT s.doc_id, s.leaf, r.subroot, root.root, sha256(s.proof) AS proof_sha256, s.node AS folded_root, s.node = root.root AS verified
FROM step s JOIN subroot r ON r.lang IS NOT DISTINCT FROM s.lang CROSS JOIN root
WHERE s.stage = 1 AND s.m = 1
"""

#: All candidates of all queries.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
