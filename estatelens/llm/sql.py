"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT item_id, least(13, len(w)) AS k, list_slice(w, i, i + least(13, len(w)) - 1) AS seq
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM win
), pos AS (
  SELECT doc_id, k, i, list_slice(w, i, i + k - 1) AS seq
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)
), hit AS (
  SELECT DISTINCT doc_id, item_id, p.k, i FROM pos p JOIN win USING (k, seq)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op9_exact_dedup": f"""
WITH h AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)
""",
    "op10_chat_format": """
WITH t AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         CAST(floor(coalesce(turn, -1) / 256) AS BIGINT) AS part
  FROM conversations
), s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'
), r AS (
  SELECT t.conv_id, speaker, part, turn, role, text, role = speaker AS own,
         CASE WHEN role = speaker THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user|>' || chr(10) || role || ': ' END AS head
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), o AS (
  SELECT *, row_number() OVER w AS k,
         sum(length(head) + length(text) + 8) OVER w - length(text) - 8 AS first
  FROM r WINDOW w AS (PARTITION BY conv_id, speaker, part ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, speaker, part, CAST(0 AS BIGINT) AS lane, count(*) AS n_turns,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(first AS BIGINT) || '+' || (length(text) + 7), ',' ORDER BY k) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, speaker, part
""",
}
