"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from .mixing import BUDGET_PERCENT, REPEATS, SEED, WEIGHTS
from .quality_rules import BASE_LEAST_WORDS, BASE_MOST_REPEATED, RULES, STOP_WORDS, SYMBOLS, WINDOW

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _broken(rule) -> str:
    tests = []
    if rule.low is not None:
        tests.append(f"100 * {rule.count} < {rule.low} * {rule.per}")
    if rule.high is not None:
        tests.append(f"100 * {rule.count} > {rule.high} * {rule.per}")
    return f"(n_words >= {rule.from_words} AND ({' OR '.join(tests)}))"


_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

OP2 = rf"""
WITH numbered AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT row_no, unnest(range(1, len(words) - {WINDOW - 2})) AS first_word,
         unnest(list_transform(range(1, len(words) - {WINDOW - 2}),
           lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' '))) AS shown
  FROM numbered WHERE len(words) >= {WINDOW}),
windows AS (
  SELECT row_no, first_word, count(*) OVER (PARTITION BY row_no, shown) AS n FROM places),
covered AS (
  SELECT row_no, count(DISTINCT first_word + k) AS n_repeat_words
  FROM windows, range({WINDOW}) AS steps(k) WHERE n > 1 GROUP BY row_no),
counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))
           AS n_cut_lines
  FROM numbered LEFT JOIN covered USING (row_no)),
judged AS (
  SELECT *, n_words < {BASE_LEAST_WORDS}
            OR 100 * n_repeat_words > {BASE_MOST_REPEATED} * n_words AS base_failed
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(_broken(rule) for rule in RULES)}) AS kept
FROM judged"""

_WEIGHT = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))

OP8 = f"""
WITH entries AS (
  SELECT doc_id, source, coalesce(text, '') AS text, CAST(len({WORDS}) AS BIGINT) AS size,
         count(*) AS n_rows, md5(concat_ws('/', '{SEED}', CAST(doc_id AS VARCHAR))) AS shuffled
  FROM documents GROUP BY ALL),
sizes AS (
  SELECT source, CAST(sum(size * n_rows) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM entries GROUP BY source),
weighed AS (
  SELECT *, CAST(CASE place % {len(WEIGHTS)} {_WEIGHT} END AS BIGINT) AS weight FROM sizes),
dry AS (
  SELECT *, {REPEATS} * source_size / weight AS dry,
         coalesce(sum({REPEATS} * source_size) OVER before, 0) AS cap_before,
         coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM weighed
  WINDOW before AS (ORDER BY {REPEATS} * source_size / weight, place
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT first(level ORDER BY dry, place) AS level FROM (
    SELECT dry, place,
           (CAST((SELECT sum(source_size) FROM weighed) AS DOUBLE) * {BUDGET_PERCENT} / 100
            - CAST(cap_before AS DOUBLE))
           / CAST((SELECT sum(weight) FROM weighed) - weight_before AS DOUBLE) AS level
    FROM dry)
  WHERE level <= dry),
targets AS (
  SELECT *, least(CAST({REPEATS} * source_size AS DOUBLE),
                  weight * coalesce((SELECT level FROM level), 0.0)) AS target
  FROM weighed),
served AS (
  SELECT e.*, t.source_size, t.place, t.weight, t.target,
         sum(size * n_rows) OVER (PARTITION BY e.source ORDER BY shuffled, doc_id, text
                                  ROWS UNBOUNDED PRECEDING) AS served
  FROM entries e JOIN targets t ON t.source IS NOT DISTINCT FROM e.source),
turns AS (
  SELECT doc_id, source, text, size * n_rows AS words,
         sum(size * n_rows) OVER (
           ORDER BY CAST(copy * source_size + served AS DOUBLE) / weight, place, copy, shuffled,
                    doc_id, text ROWS UNBOUNDED PRECEDING) AS so_far
  FROM served, range({REPEATS}) AS copies(copy) WHERE size > 0),
taken AS (
  SELECT doc_id, source, text, count(*) AS copies FROM turns
  WHERE so_far * 100 <= (SELECT sum(source_size) FROM weighed) * {BUDGET_PERCENT}
  GROUP BY ALL)
SELECT s.doc_id, s.size, s.source_size, s.target,
       CAST(s.size * coalesce(t.copies, 0) AS BIGINT) AS taken
FROM (SELECT *, unnest(range(n_rows)) AS row_of FROM served) s
LEFT JOIN taken t ON t.doc_id IS NOT DISTINCT FROM s.doc_id
  AND t.source IS NOT DISTINCT FROM s.source AND t.text = s.text"""

# Terms are cut by the engine's own regular expressions; every document is scored for every item.
OP11 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS terms
  FROM documents
), sizes AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0)::BIGINT AS docs, sum(len(terms))::BIGINT AS words FROM texts
), postings AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts)
  GROUP BY ALL
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, sizes WHERE term IN (SELECT term FROM wanted) GROUP BY term, docs
), parts AS (
  SELECT row_no, doc_id, term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS part
  FROM postings JOIN weights USING (term), sizes
), scores AS (
  SELECT item_id, row_no, doc_id, sum(part)::BIGINT AS score
  FROM wanted JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST))::INTEGER AS rank
  FROM scores
) WHERE rank <= 10
"""
