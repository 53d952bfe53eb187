"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from panelforge.llm.secrets import BASE, MORE, Rule

_BLANK = r"[\x20\x09-\x0D]"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS i FROM w WHERE len(words) > 0))),
n AS (SELECT w.doc_id, count(s.shingle) AS n_shingles FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
link AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n_shingles + q.n_shingles - shared)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) l ON l.a = r.other)
SELECT doc_id, any_value(n_shingles) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN n USING (doc_id) GROUP BY doc_id
"""

QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS body, {_WORDS} AS words, list_aggregate({_WORDS}, 'mode') AS top,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
t AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM t WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '\pL'))) AS lettered,
         len(list_filter(lines, lambda x: regexp_matches(x, '^{_BLANK}*[•\-*●]'))) AS bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…){_BLANK}*$'))) AS cut,
         len(list_filter(words, lambda x: x = top)) AS commonest
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines
            OR 2 * lettered < n_words OR (n_lines > 1 AND 10 * bullets > 9 * n_lines) OR 2 * cut > n_lines OR 10 * commonest > 4 * n_words) AS kept
FROM b
"""

LINE_DEDUP = rf"""
WITH l AS (
  SELECT doc_id, line, pos, translate(regexp_replace(regexp_replace(line, '^{_BLANK}+', ''), '{_BLANK}+$', ''), '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
d AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, coalesce(d.last <> l.doc_id, false) AS dropped FROM l LEFT JOIN d USING (key))
SELECT doc_id, count(*) AS n_lines, count(CASE WHEN dropped THEN 1 END) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def _matches(place: int, rule: Rule) -> str:
    """One row per match of a rule: the gaps before it and the matches before it give its start."""
    pattern = rule.pattern.replace("'", "''")
    return rf"""
SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, start, start + length(whole[i]) AS stop FROM (
  SELECT *, list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start FROM (
    SELECT doc_id, whole, value, gap, unnest(generate_series(1, len(whole))) AS i FROM (
      SELECT doc_id, regexp_extract_all(body, '{pattern}', 0) AS whole, regexp_extract_all(body, '{pattern}', {rule.group}) AS value,
             string_split_regex(body, '{pattern}') AS gap FROM d)))
WHERE length(value[i]) >= {rule.least}"""


def secret_scan(base: Sequence[Rule] = BASE, more: Sequence[Rule] = MORE) -> str:
    found = " UNION ALL ".join(_matches(i, r) for i, r in enumerate([*base, *more]))
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place){}, '')"
    own = " FILTER (WHERE place < {})".format(len(base))
    counts = ", ".join(f"count(CASE WHEN place = {i} THEN 1 END) AS n_{r.kind}" for i, r in enumerate(base))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
m AS (SELECT doc_id, place, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM ({found}))
SELECT doc_id, {counts}, sha256({joined.format(own)}) AS base_sha256, {joined.format('')} AS spans
FROM d LEFT JOIN m USING (doc_id) GROUP BY doc_id
"""


def _base32(hexadecimal: str) -> str:
    """Base32 of 160 bits: every five hexadecimal digits are four base32 digits."""
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> {}) & 31), 1)"
    four = " || ".join(digit.format(n) for n in (15, 10, 5, 0))
    return f"array_to_string(list_transform(list_transform(generate_series(0, 7), lambda g: CAST('0x' || substr({hexadecimal}, 1 + 5 * g, 5) AS INTEGER)), lambda v: {four}), '')"


WARC = f"""
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_base32('digest')} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, body, sha1(body) AS digest, min(page_id) OVER (PARTITION BY body) AS first
      FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""

#: CRC-32 of an ASCII string s (reflected polynomial), as an unsigned number.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(s, ''), lambda x: ascii(x)::BIGINT),
  lambda r, b: list_reduce([xor(r, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

PREFIX_TRIE = rf"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, len({_WORDS}) AS words, turn
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM t),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS head, {_CRC32} % 4 AS h
  FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM p)),
r AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth FROM (
    SELECT c.conv_id, digest, words, place, 0 AS own FROM c JOIN p ON p.conv_id = c.head AND place <= h
    UNION ALL
    SELECT c.conv_id, digest, words, place, 1 FROM c JOIN p ON p.conv_id = c.conv_id AND place > h)),
m AS (
  SELECT conv_id, depth, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path,
         depth = max(depth) OVER (PARTITION BY conv_id) AS is_end
  FROM r
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM r) FROM c),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM m GROUP BY path, depth),
k AS (SELECT left(path, -32) AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, depth)),
s AS (
  SELECT a.path, a.depth, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words)::BIGINT AS saved_tokens
  FROM v a JOIN v b ON starts_with(b.path, a.path) GROUP BY ALL)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM v JOIN s USING (path, depth) LEFT JOIN v up ON v.depth > 0 AND up.path = left(v.path, -32) AND up.depth = v.depth - 1
"""
