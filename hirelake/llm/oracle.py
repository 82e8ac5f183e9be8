"""SQL for the queries that SQL can express."""

from hirelake.plans.oracle import page_text, squeezed


def uuid(kind: str, of: str) -> str:
    key = f"md5('{kind}:' || {of})"
    return (
        f"'<urn:uuid:' || {key}[1:8] || '-' || {key}[9:12] || '-3' || {key}[14:16] || '-8' || {key}[18:20]"
        f" || '-' || {key}[21:32] || '>'"
    )


ORACLE_SQL = {
    "op1_mix_sources": """
WITH sized AS (
  SELECT doc_id, source, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0::DOUBLE * sum(size) AS cap,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS fixed, sum(weight) OVER after AS open,
         (SELECT 1.5 * sum(source_size) FROM sources) AS budget
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT CAST(arg_min((budget - fixed) / open, cap / weight)
                FILTER (WHERE (budget - fixed) / open < cap / weight) AS DOUBLE) AS level
  FROM ordered),
targets AS (
  SELECT source, source_size, CAST(least(cap, weight * coalesce(level, cap / weight)) AS DOUBLE) AS target
  FROM sources, level),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) % source_size ELSE 0 END AS rest
  FROM targets),
keyed AS (
  SELECT source, key, sum(size) AS words,
         coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY key
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized GROUP BY source, key)
SELECT s.doc_id, s.size, p.source_size, p.target,
       CAST(p.epochs * s.size + CASE WHEN k.before + k.words <= p.rest THEN s.size
                                     WHEN k.before <= p.rest AND k.words > 0
                                       THEN s.size * (p.rest - k.before) // k.words
                                     ELSE 0 END AS BIGINT) AS taken
FROM sized s
JOIN plans p ON s.source IS NOT DISTINCT FROM p.source
JOIN keyed k ON s.source IS NOT DISTINCT FROM k.source AND s.key = k.key
""",
    "op3_perspective_rotation": """
WITH messages AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
people AS (
  SELECT DISTINCT conv_id, role AS assistant FROM messages WHERE role IS NOT NULL AND role <> 'system'),
seen AS (
  SELECT m.conv_id, p.assistant, m.turn, m.role, m.text, coalesce(m.role = p.assistant, false) AS own,
         '<|im_start|>' || CASE WHEN m.role = 'system' THEN 'system' WHEN m.role = p.assistant THEN 'assistant'
                                ELSE 'user' || coalesce(' name=' || m.role, '') END || chr(10) AS header
  FROM messages m JOIN people p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(header) + length(text) + 11) OVER w, 0) + length(header) AS start
  FROM seen
  WINDOW w AS (PARTITION BY conv_id, assistant ORDER BY turn NULLS LAST, role NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, assistant, CAST(0 AS BIGINT) AS block, count(*) AS n_messages,
       string_agg(header || text || '<|im_end|>' || chr(10), '' ORDER BY start) AS text,
       coalesce(string_agg(start::BIGINT || '+' || (length(text) + 11), ' ' ORDER BY start) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, assistant
""",
    "op9_warc_derivatives": f"""
WITH known AS (
  SELECT {uuid("response", "page_id || ' ' || url")} AS refers_to, url, html,
         ['Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(html)] AS sent,
         regexp_extract(html, '(?is)<html[^>]*\\slang=["'']?([A-Za-z-]+)', 1) AS language,
         {squeezed("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
         regexp_extract_all(html, '(?is)<a\\s[^>]*?href=["'']([^"'']*)["'']', 1) AS links
  FROM pages),
made AS (
  SELECT {uuid("metadata", "refers_to")} AS record_id, 'metadata' AS warc_type, refers_to, url, html, sent,
         'application/warc-fields' AS content_type,
         array_to_string(list_transform(
           list_concat(list_transform(sent, lambda x: 'source-header: ' || x),
                       CASE WHEN title <> '' THEN ['title: ' || title] ELSE [] END,
                       CASE WHEN language <> '' THEN ['language: ' || language] ELSE [] END,
                       list_transform(links, lambda x: 'outlink: ' || x)),
           lambda x: x || chr(13) || chr(10)), '') AS block
  FROM known
  UNION ALL
  SELECT {uuid("conversion", "refers_to")}, 'conversion', refers_to, url, html, sent,
         'text/plain; charset=utf-8', {page_text("html")}
  FROM known)
SELECT record_id, warc_type, refers_to, url AS target_uri, '2024-01-01T00:00:00Z' AS date, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest,
       'sha256:' || sha256(html) AS payload_digest, 200 AS source_status,
       array_to_string(sent, chr(10)) AS source_headers, block
FROM made
""",
}
