"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from careflow.llm.chat_formatting import CLOSING, OTHER_HEADER, OWN_HEADER
from careflow.llm.decontamination import AGREE, SHORT, WINDOW
from careflow.llm.license_scan import COVER, GRAM, NOTICES, PHRASES, SHIFT
from careflow.llm.quality_rules import MIN_WORDS, OWN_ROWS, POOL_ROWS, REPEATED


def _text(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def license_scan() -> str:
    templates = ", ".join(
        f"({i}, {str(i < len(PHRASES)).lower()}, {_text(label)}, {_text(phrase)})" for i, (phrase, label) in enumerate((*PHRASES, *NOTICES))
    )
    return f"""
WITH template(template, base, label, phrase) AS (VALUES {templates}),
grams AS (
  SELECT template, base, label, len(w) AS size, t AS tpos, w[t + 1] AS g0, w[t + 2] AS g1, w[t + 3] AS g2
  FROM (SELECT template, base, label, w, unnest(range(len(w) - {GRAM} + 1)) AS t
        FROM (SELECT template, base, label, string_split(phrase, ' ') AS w FROM template))),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(len(w) - {GRAM} + 1)) AS p FROM words),
votes AS (
  SELECT DISTINCT doc_id, template, base, label, size, tpos, p - tpos AS diagonal
  FROM (SELECT doc_id, p, w[p + 1] AS w0, w[p + 2] AS w1, w[p + 3] AS w2 FROM places)
  JOIN grams ON w0 = g0 AND w1 = g1 AND w2 = g2),
base AS (
  SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, list(DISTINCT label) AS labels
  FROM (SELECT doc_id, template, label, diagonal FROM votes WHERE base GROUP BY doc_id, template, label, diagonal HAVING count(*) = max(size) - {GRAM} + 1)
  GROUP BY doc_id),
apart AS (
  SELECT doc_id, template, diagonal,
         CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {SHIFT} THEN 0 ELSE 1 END AS opens
  FROM (SELECT DISTINCT doc_id, template, diagonal FROM votes)),
parted AS (
  SELECT doc_id, template, diagonal, sum(opens) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM apart),
covered AS (
  SELECT doc_id, template, label, size, span, count(DISTINCT tpos + k) / size AS cover, count(DISTINCT diagonal) AS diagonals,
         min(diagonal + tpos) AS first, max(diagonal + tpos + {GRAM} - 1) AS last
  FROM (SELECT v.*, p.span, unnest([0, 1, 2]) AS k FROM votes v JOIN parted p USING (doc_id, template, diagonal) WHERE NOT base)
  GROUP BY doc_id, template, label, size, span HAVING count(DISTINCT tpos + k) / size >= {COVER}),
islands AS (
  SELECT *, CASE WHEN first <= max(last) OVER (PARTITION BY doc_id ORDER BY first, last, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 THEN 0 ELSE 1 END AS opens FROM covered),
grouped AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY first, last, template ROWS UNBOUNDED PRECEDING) AS island FROM islands),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, island ORDER BY cover DESC, diagonals, size DESC, template) AS place FROM grouped),
noticed AS (SELECT doc_id, max(cover) AS score, list(DISTINCT label) AS labels FROM best WHERE place = 1 GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0) END::DOUBLE AS score
FROM words LEFT JOIN base b USING (doc_id) LEFT JOIN noticed n USING (doc_id)
"""


QUALITY_STATS = f"""
raw AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
grams AS (
  SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM raw)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM again WHERE n > 1) GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '^\\p{{Lu}}\\p{{Lu}}')))::BIGINT AS n_shouts,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM raw LEFT JOIN repeats USING (doc_id)),
stats AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
         n_symbols / greatest(n_words, 1) AS symbols, n_repeat_words / greatest(n_words, 1) AS repeats,
         n_dup_lines / greatest(n_lines, 1) AS dup_lines, n_shouts / greatest(n_words, 1) AS shouts, word_chars / greatest(n_words, 1) AS word_length
  FROM counts)"""


def quality_rules() -> str:
    least = {"symbols": 0.1, "repeats": 0.25, "dup_lines": 0.3, "shouts": 0.2, "word_length": 4.0}
    limits = ", ".join(
        f"quantile_disc({f}, 0.75) + greatest(6 * (quantile_disc({f}, 0.75) - quantile_disc({f}, 0.25)), {v}) AS {f}" for f, v in least.items()
    )
    votes = ", ".join(f"quantile_disc({f}, 0.5) AS {f}" for f in least)
    large = ", ".join(least)
    small = ", ".join(f"CASE WHEN p.n >= {POOL_ROWS} THEN p.{f} ELSE coalesce(v.{f}, p.{f}) END AS {f}" for f in least)
    beyond = " OR ".join(f"coalesce(s.{f} > m.{f}, false)" for f in least)
    return f"""
WITH {QUALITY_STATS},
measured AS (SELECT *, count(*) OVER (PARTITION BY lang, source) AS n_source FROM stats WHERE NOT base_failed),
own AS (SELECT lang, source, count(*) AS n, {limits} FROM measured GROUP BY lang, source),
pool AS (SELECT lang, count(*) AS n, {limits} FROM measured WHERE n_source < {OWN_ROWS} GROUP BY lang),
votes AS (SELECT lang, {votes} FROM own WHERE n >= {OWN_ROWS} GROUP BY lang),
bounds AS (
  SELECT lang, source, {large} FROM own WHERE n >= {OWN_ROWS}
  UNION ALL
  SELECT o.lang, o.source, {small} FROM own o JOIN pool p ON o.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN votes v ON o.lang IS NOT DISTINCT FROM v.lang WHERE o.n < {OWN_ROWS})
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({beyond}) AS kept
FROM stats s LEFT JOIN bounds m ON s.lang IS NOT DISTINCT FROM m.lang AND s.source IS NOT DISTINCT FROM m.source
"""


def chat_formatting() -> str:
    before, after = OTHER_HEADER.split("{}")
    return f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS t FROM conversations),
views AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns),
seen AS (
  SELECT conv_id, perspective, turn, speaker, t, speaker = perspective AS is_learned,
         CASE WHEN speaker = perspective THEN {_text(OWN_HEADER)} ELSE {_text(before)} || speaker || {_text(after)} END AS header
  FROM turns JOIN views USING (conv_id)),
sized AS (SELECT *, header || t || {_text(CLOSING)} AS rendered FROM seen),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position, sum(length(rendered)) OVER w AS end_char
  FROM sized WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, t ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position::BIGINT AS position, turn, speaker, CASE WHEN is_learned THEN 'assistant' ELSE 'user' END AS chat_role,
       rendered, (end_char - length(rendered))::BIGINT AS start_char, end_char::BIGINT AS end_char, is_learned,
       CASE WHEN is_learned THEN (end_char - length(rendered) + length(header))::BIGINT END AS learn_from,
       CASE WHEN is_learned THEN end_char::BIGINT END AS learn_to
FROM placed
"""


def decontamination() -> str:
    return f"""
WITH items AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM benchmark),
docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM documents),
item_words AS (SELECT item_id, len(w) AS size, unnest(range(len(w))) AS t, unnest(w) AS word FROM items),
doc_words AS (SELECT doc_id, len(w) AS n, unnest(range(len(w))) AS p, unnest(w) AS word FROM docs),
same AS (SELECT doc_id, item_id, size, n, p - t AS diagonal, t FROM doc_words JOIN item_words USING (word)),
dense AS (SELECT doc_id, item_id, diagonal FROM same GROUP BY doc_id, item_id, diagonal HAVING count(*) >= least({AGREE}, min(size) - CASE WHEN min(size) > {SHORT} THEN min(size) * {WINDOW - AGREE} // {WINDOW} ELSE 0 END)),
windows AS (
  SELECT s.*, count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY t RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS agree,
         least(size, n - diagonal) - greatest(0, -diagonal) AS compared
  FROM same s JOIN dense USING (doc_id, item_id, diagonal)),
places AS (
  SELECT doc_id, item_id, diagonal, count(*) AS n_agree, min(compared) AS n_compared, greatest(diagonal, 0) AS first_word
  FROM windows GROUP BY doc_id, item_id, diagonal
  HAVING (min(compared) >= {WINDOW} AND max(agree) >= {AGREE})
      OR (min(size) < {WINDOW} AND min(compared) = min(size)
          AND count(*) >= min(size) - CASE WHEN min(size) > {SHORT} THEN min(size) * {WINDOW - AGREE} // {WINDOW} ELSE 0 END)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_agree DESC, diagonal) AS place FROM places)
SELECT doc_id, item_id, n_agree::BIGINT AS n_agree, n_compared::BIGINT AS n_compared, first_word::BIGINT AS first_word FROM best WHERE place = 1
"""


ORACLE: dict[str, str] = {
    "op2_license_scan": license_scan(),
    "op6_decontamination": decontamination(),
    "op8_quality_rules": quality_rules(),
    "op10_chat_formatting": chat_formatting(),
}
