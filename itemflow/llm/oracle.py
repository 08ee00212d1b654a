"""The same answers in DuckDB's SQL, for the operators that SQL expresses."""

from itemflow.llm.line_quality import BOILERPLATE, NAVIGATION, TERMINAL


def _ends() -> str:
    return " OR ".join("ends_with(t, '" + m.replace("'", "''") + "')" for m in TERMINAL)


def _phrases() -> str:
    return " OR ".join(f"contains(low, '{p}')" for p in (*BOILERPLATE, *NAVIGATION))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_SIGN = "'[#*$%&|<>]'"

ORACLE = {
    "op2_line_quality": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, text IS NULL AS none FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, {_WORD}) AS ws FROM d),
p AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
q AS (SELECT doc_id, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM q WHERE c IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
t AS (SELECT doc_id, i, line, regexp_replace(line, '[\x20\x09-\x0D]+$', '') AS t, translate(line, {_AZ}) AS low,
  len(regexp_extract_all(line, {_SIGN})) AS signs,
  coalesce(length(array_to_string(regexp_extract_all(line, {_WORD}), '')), 0) AS chars FROM l),
f AS (SELECT doc_id, line, chars, chars > 0 AND (
  NOT ({_ends()}) OR 10 * signs > chars OR length(line) - length(replace(line, '|', '')) > 1
  OR regexp_matches(line, '!!.*!!|!!!') OR {_phrases()}) AS fails, signs FROM t),
s AS (SELECT doc_id, count(*) AS n_lines, sum(chars)::BIGINT AS word_chars, sum(signs)::BIGINT AS n_symbols,
  count(*) FILTER (fails) AS lines_removed, coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS chars_removed,
  count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines,
  coalesce(sum(strlen(line)) FILTER (NOT fails), 0) + greatest(count(*) FILTER (NOT fails) - 1, 0) AS clean FROM f GROUP BY doc_id),
a AS (SELECT s.*, none, len(ws)::BIGINT AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM s JOIN w USING (doc_id) JOIN d USING (doc_id) LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * chars_removed <= 30 * word_chars AS kept,
  n_lines, lines_removed, chars_removed, CASE WHEN none THEN NULL ELSE clean::BIGINT END AS clean_bytes FROM a""",
    "op3_decontamination": rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
win AS (SELECT DISTINCT item, least(len(ws), 10) AS n, ws[k : k + least(len(ws), 10) - 1] AS g
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS k FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, k, ws[k : k + n - 1] AS g
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS k FROM dw, sizes WHERE len(ws) >= n)),
hit AS (SELECT doc_id, item, pos.n, k FROM pos JOIN win ON pos.n = win.n AND pos.g = win.g),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS place FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE f AS (SELECT doc_id, lang, row_number() OVER () AS row, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR] AS f, text,
  list_reduce(list_prepend(4294967295, [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
    lambda h, c: list_reduce([xor(h, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: xor(b // 2, 3988292384 * (b % 2)))) AS crc FROM documents),
l AS (SELECT doc_id, lang, row, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN sha256(fields || coalesce(strlen(text) || ':' || translate(text, {_AZ}), '-')) END AS tampered
  FROM (SELECT *, array_to_string([coalesce(strlen(v) || ':' || v, '-') FOR v IN f], '') AS fields FROM f)),
p AS (SELECT *, coalesce('=' || lang, '-') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS i FROM l),
t AS (SELECT g, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM p
  UNION ALL
  SELECT g, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM t WHERE n > 1 GROUP BY g, level, i // 8),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, i, subroot AS h, n FROM s
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM u WHERE n > 1 GROUP BY level, i // 8),
tn AS (SELECT *, string_agg(h, '') OVER (PARTITION BY g, level, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
  string_agg(h, '') OVER (PARTITION BY g, level, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM t WHERE n > 1),
un AS (SELECT *, string_agg(h, '') OVER (PARTITION BY level, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
  string_agg(h, '') OVER (PARTITION BY level, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM u WHERE n > 1),
w AS (SELECT p.row, level, coalesce(l, '') AS l, coalesce(r, '') AS r FROM p, tn WHERE tn.g = p.g AND tn.i = p.i // (8 ** level)::BIGINT
  UNION ALL SELECT p.row, 1000 + level, coalesce(l, ''), coalesce(r, '') FROM p JOIN s USING (g), un WHERE un.i = s.i // (8 ** level)::BIGINT),
v AS (SELECT row, list({{'l': l, 'r': r}} ORDER BY level) AS path FROM w GROUP BY row),
a AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(v.path, []) AS path, coalesce(tampered, leaf) AS claimed
  FROM p JOIN s USING (g) LEFT JOIN v USING (row)),
b AS (SELECT *, sha256(array_to_string([x.l || x.r FOR x IN path], '')) AS proof_sha256,
  list_reduce(list_prepend({{'l': claimed, 'r': ''}}, path), lambda h, x: {{'l': sha256(x.l || h.l || x.r), 'r': ''}}).l AS folded_root FROM a)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM b""",
}
