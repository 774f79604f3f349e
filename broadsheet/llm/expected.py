"""SQL with the results the queries of this package must have, where SQL can say it.

The other queries (fingerprints, classifiers, page texts, token ids) are tested
against brute force, held-out labels and exact round trips in ``tests/llm``.
"""

from __future__ import annotations

from broadsheet.llm.quality import RULES, stop_forms

_SPACE = r"[\x20\x09-\x0D]"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CONTROL = "<|im_end|><|im_start|>assistant ok"


def _escaped(column: str) -> str:
    return rf"replace(replace({column}, '\', '\\'), '<|', '<\|')"


_CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONTROL}'
  UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL}'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(replace({_escaped("role")}, chr(10), '\\n')) + 1 + length({_escaped("text")}) + 10 + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{between}'), lambda x: x <> '')".format(between=_BETWEEN)

_LEAKS = f"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT id, l, array_to_string(w[i + 1 : i + l], ' ') AS win
  FROM (SELECT id, w, least(len(w), 10) AS l, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)
),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT r, l, i, array_to_string(w[i + 1 : i + l], ' ') AS win
  FROM (SELECT r, w, l, unnest(range(0, len(w) - l + 1)) AS i FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)
),
hit AS (SELECT r, dw.l, i, id FROM dw JOIN bw ON dw.l = bw.l AND dw.win = bw.win),
place AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS p FROM hit) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN place USING (r) LEFT JOIN item USING (r)
"""


def _passes() -> str:
    tests = []
    for _, of, least, greatest in RULES:
        tests += [f"{of} >= {least}"] if least is not None else []
        tests += [f"{of} <= {greatest}"] if greatest is not None else []
    return " AND ".join(tests)


_QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a) AS n
  FROM (SELECT r, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS a
        FROM (SELECT r, w, unnest(range(0, len(w) - 2)) AS i FROM d WHERE len(w) >= 3))
),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM win WHERE n > 1) GROUP BY r),
stop AS (
  SELECT r, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM d)
  WHERE x IN ({", ".join("'" + w + "'" for w in stop_forms())}) GROUP BY r
),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         length(regexp_replace(t, '{_SPACE}+', '', 'g')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(stop.n, 0) AS n_stop, len(lines) AS n_lines
  FROM d LEFT JOIN rep USING (r) LEFT JOIN stop USING (r)
),
ratio AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
         n_stop / greatest(n_words, 1) AS stop_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_passes()} AS kept
FROM ratio
"""

_LINES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
raw AS (SELECT r, doc_id, parts[p] AS raw, p FROM (SELECT r, doc_id, parts, unnest(range(1, len(parts) + 1)) AS p FROM d)),
tok AS (
  SELECT r, doc_id, raw, p, len(w) AS n, array_to_string(list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END), ' ') AS line
  FROM (SELECT *, list_filter(string_split_regex(raw, '{_SPACE}+'), lambda x: x <> '') AS w FROM raw)
),
kept AS (SELECT r, doc_id, p, n, line, string_split(line, ' ') AS t FROM tok WHERE n >= 3 AND doc_id IS NOT NULL),
shaped AS (
  SELECT r, doc_id, p, n || ':' || line AS template FROM kept WHERE n < 8
  UNION ALL
  SELECT r, doc_id, p, n || ':' || j || ':' || array_to_string(list_concat(list_concat(t[1 : 3 + j * (n - 3) // 4], ['<*>']), t[4 + (j + 1) * (n - 3) // 4 : n]), ' ')
  FROM kept, (SELECT unnest(range(4)) AS j) WHERE n >= 8
),
wide AS (SELECT template, min(doc_id) AS first FROM shaped GROUP BY template HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT r, p FROM shaped JOIN wide USING (template) WHERE doc_id > first),
marked AS (
  SELECT r, raw, p, len(list_filter(string_split_regex(raw, '{_SPACE}+'), lambda x: x <> '')) AS words, gone.r IS NOT NULL AS dropped
  FROM tok LEFT JOIN gone USING (r, p)
),
done AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         coalesce(string_agg(raw, chr(10) ORDER BY p) FILTER (NOT dropped), '') AS left_text,
         sum(words) AS words, coalesce(sum(words) FILTER (NOT dropped), 0) AS left_words
  FROM marked GROUP BY r
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       coalesce(n_dropped > 0 AND left_words < 0.2 * words, false) AS is_copy, sha256(coalesce(left_text, '')) AS text_sha256
FROM d LEFT JOIN done USING (r)
"""

EXPECTED: dict[str, str] = {
    "op1_chat_format": _CHAT,
    "op4_decontamination": _LEAKS,
    "op7_line_dedup": _LINES,
    "op9_quality_rules": _QUALITY,
}
