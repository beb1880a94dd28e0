"""The same results in DuckDB SQL, for the queries that SQL can state."""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Five hexadecimal digits are twenty bits, and so four letters of base 32.
_BITS20 = "CAST(('0x' || substr(sha, 5 * i + 1, 5)) AS INTEGER)"
_LETTERS = " || ".join(f"substr('{_BASE32}', ({_BITS20} >> {s}) % 32 + 1, 1)" for s in (15, 10, 5, 0))

ORACLES = {
    "op9_warc": f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM hashed
)
SELECT page_id, payload_bytes,
       array_to_string([{_LETTERS} FOR i IN range(8)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
""",
    "op10_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), {_FOLD}) AS line_key FROM lines
), repeated AS (
  SELECT line_key, min(doc_id) AS first FROM keyed WHERE length(line_key) >= 10
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, r.first IS NOT NULL AND r.first <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN repeated r USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
