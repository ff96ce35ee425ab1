"""DuckDB SQL for the queries that SQL can express."""

URLS_SQL = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rests AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (SELECT page_id, rest,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
fits AS (SELECT p.rest AS rest, max_by(struct_pack(r := r.host || r.path, v := r.verdict), length(r.host || r.path)) AS best
  FROM (SELECT DISTINCT rest, host, path FROM parsed) p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.rest)
SELECT p.page_id, p.host, p.path, f.best.r AS rule, coalesce(f.best.v, 'allow') AS verdict
FROM parsed p LEFT JOIN fits f ON f.rest = p.rest
"""

_ENDS = r"""'.', '!', '?', '…', '。', '！', '？', ':', ';', '"', '”', '»', '’', ')'"""
_BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookie policy|accept cookies|privacy policy|terms of (use|service)|"
    r"subscribe to our|sign up for|log ?in|click here|read more|share (this|on)|enable javascript|skip to content)\b"
)

LINES_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT rid, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM texts),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS raw FROM texts),
trimmed AS (SELECT rid, raw, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM lines),
measured AS (SELECT rid, raw, line, length(line) AS n,
    len(string_split_regex(line, '[\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) AS letters,
    length(line) - length(regexp_replace(line, '[|»›•·>]+', '', 'g')) AS bars,
    length(line) - length(regexp_replace(line, '[#*$%&|<>]+', '', 'g')) AS symbols,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS solid
  FROM trimmed),
judged AS (SELECT rid, raw, solid, n > 0 AND (
      (symbols > 0 AND 10 * symbols >= n)
      OR (bars >= 2 AND 4 * bars >= n_words)
      OR (right(line, 1) NOT IN ({_ENDS}) AND ((n_words >= 8 AND NOT regexp_matches(line, '[.!?,;:]')) OR 2 * letters < n))
      OR (n <= 160 AND regexp_matches(line, '{_BOILERPLATE}'))) AS fails
  FROM measured),
by_line AS (SELECT rid, count(*) FILTER (solid > 0) - count(DISTINCT raw) FILTER (solid > 0) AS n_dup_lines,
    coalesce(sum(solid) FILTER (NOT fails), 0) AS clean_chars FROM judged GROUP BY rid),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM worded WHERE len(w) >= 3)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeated AS (SELECT rid, count(DISTINCT pos) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY rid),
counted AS (SELECT d.rid, d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, clean_chars
  FROM worded d JOIN by_line USING (rid) LEFT JOIN repeated USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND (word_chars = 0 OR 1 - clean_chars::DOUBLE / word_chars <= 0.5) AS kept
FROM counted
"""
