"""SQL for DuckDB that gives the rows of the queries which SQL can express."""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"

SUBSTRING = rf"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, {WORD}), []) AS found FROM documents
), windows AS (
  SELECT doc_id, k, array_to_string(found[k + 1 : k + 20], ' ') AS words
  FROM (SELECT doc_id, found, unnest(range(0, len(found) - 19)) AS k FROM words)
), ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY words ORDER BY doc_id, k) AS n FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS place FROM ranked WHERE n > 1
), placed AS (
  SELECT doc_id, unnest(found) AS word, unnest(range(0, len(found))) AS place FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text FROM placed ANTI JOIN gone USING (doc_id, place)
  GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT w.doc_id, len(w.found)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id) LEFT JOIN counts c USING (doc_id)
"""

VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reached AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(l.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id
"""

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {WORD})), 0)::BIGINT AS size,
    md5('11:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS mark
  FROM documents
), summed AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (place - 1) % 3] AS weight, 2.0::DOUBLE * source_size AS cap FROM summed
), levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), sources AS (
  SELECT source, place, source_size,
    least(cap, coalesce((max(CASE WHEN level <= cap / weight THEN level END) OVER ()) * weight, cap)) AS target,
    greatest(1, ceil(source_size / 500000.0))::BIGINT AS shards,
    floor(1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE / 8 + 0.5)::BIGINT AS seats
  FROM levels
), source_quotients AS (
  SELECT place, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place) AS n, seats
  FROM (SELECT *, unnest(range(0, least(seats, ceil(source_size / 4.0)::BIGINT + 2))) AS k FROM sources)
), source_quotas AS (
  SELECT place, count(*) AS blocks FROM source_quotients WHERE n <= seats GROUP BY place
), dealt AS (
  SELECT z.doc_id, z.size, z.mark, s.*, coalesce(q.blocks, 0) AS blocks,
    ('0x' || substr(z.mark, 1, 8))::UBIGINT::BIGINT % s.shards AS shard
  FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source LEFT JOIN source_quotas q USING (place)
), parts AS (
  SELECT place, shard, shard // 1000 AS batch, any_value(blocks) AS blocks, sum(size)::BIGINT AS shard_size
  FROM dealt GROUP BY place, shard
), batch_quotients AS (
  SELECT place, batch, blocks,
    row_number() OVER (PARTITION BY place ORDER BY batch_size::DOUBLE / (2 * k + 1) DESC, batch) AS n
  FROM (
    SELECT *, unnest(range(0, blocks)) AS k
    FROM (SELECT place, batch, any_value(blocks) AS blocks, sum(shard_size) AS batch_size FROM parts GROUP BY place, batch)
  )
), batch_quotas AS (
  SELECT place, batch, count(*) AS seats FROM batch_quotients WHERE n <= blocks GROUP BY place, batch
), part_quotients AS (
  SELECT place, batch, shard, seats,
    row_number() OVER (PARTITION BY place, batch ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard) AS n
  FROM (SELECT *, unnest(range(0, seats)) AS k FROM parts JOIN batch_quotas USING (place, batch))
), part_quotas AS (
  SELECT place, shard, count(*) AS quota FROM part_quotients WHERE n <= seats GROUP BY place, shard
), ordered AS (
  SELECT d.*, greatest(1, ceil(p.shard_size / 8.0))::BIGINT AS n_blocks, coalesce(q.quota, 0)::BIGINT AS quota,
    sum(d.size) OVER (PARTITION BY d.place, d.shard ORDER BY d.mark, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM dealt d JOIN parts p USING (place, shard) LEFT JOIN part_quotas q USING (place, shard)
)
SELECT doc_id, source, size, source_size, target,
  (size * (least(quota, 2 * n_blocks) // n_blocks)
    + greatest(0, least(size, (least(quota, 2 * n_blocks) % n_blocks) * 8 - start)))::BIGINT AS taken
FROM ordered
"""

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), written AS (
  SELECT *, '<|im_start|>' || regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')
    || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS formatted
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

SQL = {
    "op3_substring_dedup": SUBSTRING,
    "op5_vector_links": VECTORS,
    "op9_source_mix": MIX,
    "op12_chat_format": CHAT,
}
