"""The same results in DuckDB SQL."""

from __future__ import annotations

from vendora.llm.licenses import TEMPLATES
from vendora.llm.quality_rules import STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"


def _listed(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '{_WORD}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS n
  FROM d
), g AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1
), repeats AS (
  SELECT rid, count(*) AS c
  FROM (SELECT DISTINCT rid, i + k AS p FROM again, (VALUES (0), (1), (2)) AS k(k)) GROUP BY rid
), m AS (
  SELECT doc_id,
         len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(n) - len(list_distinct(n)))::BIGINT AS n_dup_lines,
         coalesce(c, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_listed(STOP_WORDS)})))::BIGINT AS n_stop_words,
         len(n)::BIGINT AS n_lines
  FROM w LEFT JOIN repeats USING (rid)
), v AS (
  SELECT *,
         list_filter([
           CASE WHEN n_words < 50 THEN 'min_words' END,
           CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_words' END], lambda x: x IS NOT NULL) AS base,
         list_filter([
           CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 'word_length' END,
           CASE WHEN 4 * n_symbols > n_words THEN 'symbols' END,
           CASE WHEN 25 * n_stop_words < n_words THEN 'stop_words' END,
           CASE WHEN 2 * n_dup_lines > n_lines THEN 'repeated_lines' END], lambda x: x IS NOT NULL) AS more
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines,
       len(base) > 0 AS base_failed, len(base) + len(more) = 0 AS kept,
       array_to_string(base || more, ',') AS failed_rules
FROM v
"""

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '{_ITEM_WORD}') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWERED}, '{_ITEM_WORD}') AS w FROM benchmark
), b2 AS (
  SELECT item_id, w, least(10, len(w)) AS l FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS g
  FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM b2)
), lengths AS (
  SELECT DISTINCT l FROM windows
), grams AS (
  SELECT rid, l, s, array_to_string(w[s:s + l - 1], ' ') AS g
  FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, lengths)
), found AS (
  SELECT rid, s, l, item_id FROM grams JOIN windows USING (l, g)
), hit AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM found))
  GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

OP8 = r"""
WITH given AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, 'unknown') AS who, coalesce(text, '') AS t
  FROM conversations
), sides AS (
  SELECT DISTINCT conv_id, who AS side FROM given WHERE who <> 'system'
), seen AS (
  SELECT rid, g.conv_id, side, turn, who, t,
         CASE WHEN who = 'system' THEN 'system' WHEN who = side THEN 'assistant' ELSE 'user' END AS role
  FROM given g JOIN sides s ON g.conv_id IS NOT DISTINCT FROM s.conv_id
), rendered AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || who ELSE '' END || chr(10)
            || t || '<|im_end|>' || chr(10) AS segment
  FROM seen
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position,
         coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM rendered WINDOW w AS (PARTITION BY conv_id, side ORDER BY turn NULLS LAST, who, t, rid)
)
SELECT conv_id, side, position::BIGINT AS position, turn, role, CASE WHEN role = 'user' THEN who END AS name, segment, begins,
       begins + length(segment) AS ends,
       CASE WHEN role = 'assistant' THEN begins + length('<|im_start|>assistant') + 1 END AS mask_begins,
       CASE WHEN role = 'assistant' THEN begins + length(segment) - 1 END AS mask_ends
FROM placed
"""

_NOTICES = ", ".join("({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(TEMPLATES))

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '{_ITEM_WORD}') AS w FROM documents
), notices AS (
  SELECT template, label, regexp_extract_all({_LOWERED}, '{_ITEM_WORD}') AS tw
  FROM (VALUES {_NOTICES}) AS v(template, label, text)
), phrases(label, pw) AS (
  VALUES ('mit', ['mit', 'license']), ('apache', ['apache', 'license']), ('gpl', ['general', 'public', 'license'])
), placed AS (
  SELECT rid, label, s - 1 AS s
  FROM (SELECT rid, w, label, pw, unnest(range(1, len(w) - len(pw) + 2)) AS s FROM d, phrases WHERE list_contains(w, 'license'))
  WHERE w[s:s + len(pw) - 1] = pw
), base AS (
  SELECT rid, count(*) AS n, min(s) AS first_word, max(s) AS last_word, list(DISTINCT label) AS labels FROM placed GROUP BY rid
), grams AS (
  SELECT rid, s, array_to_string(w[s:s + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS s FROM d)
), index AS (
  SELECT template, s, array_to_string(tw[s:s + 4], ' ') AS g
  FROM (SELECT template, tw, unnest(range(1, len(tw) - 3)) AS s FROM notices)
), votes AS (
  SELECT rid, template, grams.s - index.s AS diagonal, count(*) AS votes FROM grams JOIN index USING (g) GROUP BY ALL
), parted AS (
  SELECT votes.*, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal)
                           > least(8, len(tw) // 4), true) AS apart
  FROM votes JOIN notices USING (template)
), bundled AS (
  SELECT *, sum(apart::INT) OVER (PARTITION BY rid, template ORDER BY diagonal) AS bundle FROM parted
), tries AS (
  SELECT rid, template, bundle, list(diagonal ORDER BY diagonal) AS diagonals
  FROM bundled JOIN notices USING (template) GROUP BY rid, template, bundle, tw
  HAVING sum(votes) >= greatest(1, ceil(0.25 * (len(tw) - 4)))
), aligned AS (
  SELECT rid, template, bundle, t, min(t + g) AS place
  FROM (SELECT rid, template, bundle, unnest(diagonals) AS g FROM tries)
  JOIN (SELECT template, tw, unnest(range(len(tw))) AS t FROM notices) USING (template)
  JOIN d USING (rid)
  WHERE t + g >= 0 AND w[t + g + 1] = tw[t + 1]
  GROUP BY rid, template, bundle, t
), spans AS (
  SELECT DISTINCT rid, template, label, first, last, share
  FROM (SELECT rid, template, bundle, min(place) AS first, max(place) AS last, count(*) AS n FROM aligned GROUP BY ALL)
  JOIN (SELECT template, label, len(tw) AS size FROM notices) USING (template), LATERAL (SELECT n::DOUBLE / size AS share)
  WHERE share >= 0.8::DOUBLE
), method AS (
  SELECT rid, count(*) AS n, list(DISTINCT label) AS labels, max(share) AS score FROM spans GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(method.labels, []))), ',') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score,
       coalesce(method.n, 0)::BIGINT AS n_spans
FROM d LEFT JOIN base USING (rid) LEFT JOIN method USING (rid)
"""

SQL = {"op3_quality_rules": OP3, "op8_chat_perspectives": OP8, "op9_decontamination": OP9, "op13_license_scan": OP13}
