"""DuckDB SQL with the same rows as the queries that SQL can express."""

ORACLES = {
    "op4_reply_trees": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), coded AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') AS safe FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || role || ': ' || safe || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM coded GROUP BY conv_id
""",
    "op6_warc": r"""
WITH replicas AS (
  SELECT 1 AS replica, page_id, url, coalesce(html, '') AS html FROM pages
  UNION ALL
  SELECT 2, page_id, url, CASE page_id % 97 WHEN 5 THEN '?' || substr(coalesce(html, ''), 2)
                                            WHEN 23 THEN substr(coalesce(html, ''), 2) ELSE coalesce(html, '') END
  FROM pages, range(2) t(copy)
  WHERE copy < CASE page_id % 97 WHEN 11 THEN 0 WHEN 17 THEN 2 ELSE 1 END
  UNION ALL
  SELECT 2, page_id + 1000000000, url, coalesce(html, '') FROM pages WHERE page_id % 97 = 29
), records AS (
  SELECT replica, page_id,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Length: ' || CAST(strlen(html) AS VARCHAR)
         || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM replicas
), placed AS (
  SELECT replica, page_id, sha256(record) AS record_sha256, strlen(record) AS size,
         row_number() OVER (PARTITION BY replica ORDER BY page_id NULLS FIRST, sha256(record)) - 1 AS position
  FROM records
), offsets AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY replica ORDER BY position) AS BIGINT) AS end_offset,
         row_number() OVER (PARTITION BY replica, page_id, record_sha256 ORDER BY position) AS copy
  FROM placed
), spare AS (
  SELECT a.*, b.page_id IS NULL AND b.copy IS NULL AS alone
  FROM offsets a LEFT JOIN offsets b ON a.replica + b.replica = 3 AND a.page_id IS NOT DISTINCT FROM b.page_id
       AND a.record_sha256 = b.record_sha256 AND a.copy = b.copy
), turns AS (
  SELECT *, CASE WHEN alone THEN row_number() OVER (PARTITION BY replica, page_id, alone ORDER BY record_sha256, position) END AS turn
  FROM spare
), judged AS (
  SELECT a.*, CASE WHEN NOT a.alone THEN 'intact' WHEN b.turn IS NOT NULL THEN 'corrupt'
                   WHEN a.replica = 1 THEN 'missing' ELSE 'extra' END AS state
  FROM turns a LEFT JOIN turns b ON a.replica + b.replica = 3 AND a.page_id IS NOT DISTINCT FROM b.page_id AND a.turn = b.turn
)
SELECT page_id, position, end_offset - size AS start_offset, end_offset, record_sha256, state
FROM judged WHERE replica = 1 OR state = 'extra'
""",
    "op10_decontamination": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, list_filter(regexp_split_to_array(
           lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS width,
         array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)
), hits AS (
  SELECT d.row, p.item_id, d.i, p.width
  FROM (SELECT DISTINCT width FROM patterns) w
  JOIN (SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM d) d ON d.i + w.width - 1 <= len(d.words)
  JOIN patterns p ON p.width = w.width AND p.run = array_to_string(d.words[d.i : d.i + w.width - 1], ' ')
), covered AS (
  SELECT row, count(DISTINCT spot) AS n_hit FROM (SELECT row, unnest(range(i, i + width)) AS spot FROM hits) GROUP BY row
), items AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN items USING (row)
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS codes
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(list_inner_product(a.codes, r.codes) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored
  WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> anchor_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""",
}
