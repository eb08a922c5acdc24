"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from kalendria.llm.license_scans import TEMPLATES, THRESHOLD
from kalendria.llm.quality_rules import STOP_WORDS

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM items, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS g(i) WHERE len(w) > 0
), lens AS (SELECT DISTINCT m FROM windows),
docs AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents
), doc_windows AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM docs, lens, unnest(generate_series(1, len(w) - m + 1)) AS g(i) WHERE len(w) >= m
), met AS (
  SELECT d.doc_id, d.m, d.i, x.item_id FROM doc_windows d JOIN windows x ON d.win = x.win AND d.m = x.m
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM met, unnest(generate_series(i, i + m - 1)) AS g(p) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM met GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))

OP7 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{TOKEN}')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM t, unnest(generate_series(1, len(w) - 2)) AS u(i) WHERE len(w) >= 3
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c >= 2
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(generate_series(i, i + 2)) AS u(p) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(lines) AS n_lines,
         len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN rep USING (doc_id)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 3.0 AND 7.5 AND n_symbols / n_words <= 0.1
       AND n_stop / n_words >= 0.05 AND n_dup_lines / n_lines <= 0.5 AS kept
FROM f
"""


OP8 = rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM t, unnest(generate_series(1, len(w) - 49)) AS u(i) WHERE len(w) >= 50
), twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
p AS (SELECT DISTINCT doc_id, i + j AS p FROM twice, unnest(generate_series(0, 49)) AS u(j)),
isl AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS k FROM p),
runs AS (SELECT doc_id, min(p) - 1 AS s, max(p) AS e FROM isl GROUP BY doc_id, k),
agg AS (SELECT doc_id, sum(e - s)::BIGINT AS n, string_agg(s || ':' || e, ',' ORDER BY s) AS spans FROM runs GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, n AS n_repeat_words, spans FROM t JOIN agg USING (doc_id)
"""

_VALUES = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate((n, t) for n, ts in sorted(TEMPLATES.items()) for t in ts))
_NORMAL = f"regexp_extract_all({LOWER.format('{}')}, '[a-z0-9]+')"
_BIGRAMS = "[{0}[i] || ' ' || {0}[i + 1] for i in generate_series(1, len({0}) - 1)]"

OP5 = rf"""
WITH tpl AS (
  SELECT id, name, b, len(b) AS n, ceil(len(b) * {THRESHOLD} / (2 - {THRESHOLD}) - 1e-9) AS least, floor(len(b) * (2 - {THRESHOLD}) / {THRESHOLD} + 1e-9) AS most
  FROM (SELECT id, name, list_distinct({_BIGRAMS.format("w")}) AS b FROM (SELECT id, name, {_NORMAL.format("body")} AS w FROM (VALUES {_VALUES}) AS v(id, name, body)))
), docs AS (SELECT doc_id, {_BIGRAMS.format("w")} AS g FROM (SELECT doc_id, {_NORMAL.format("text")} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) > 1),
held AS (SELECT id, unnest(b) AS g FROM tpl),
hits AS (
  SELECT doc_id, id, i, row_number() OVER (PARTITION BY doc_id, id ORDER BY i) AS r
  FROM (SELECT doc_id, i, g[i] AS x FROM docs, unnest(generate_series(1, len(g))) AS u(i)) JOIN held ON x = held.g
), passages AS (
  SELECT a.doc_id, a.id, a.i AS s, z.i AS e FROM hits a JOIN tpl USING (id) JOIN hits z ON a.doc_id = z.doc_id AND a.id = z.id
  AND z.r >= a.r + least - 1 AND z.r < a.r + most AND z.i >= a.i AND z.i < a.i + most
), scored AS (
  SELECT doc_id, name, max(2 * len(list_intersect(p, b)) / (len(list_distinct(p)) + n)) AS score
  FROM (SELECT doc_id, name, b, n, g[s:e] AS p FROM passages JOIN docs USING (doc_id) JOIN tpl USING (id)) GROUP BY doc_id, name
), agg AS (
  SELECT doc_id, first(name ORDER BY score DESC, name) AS license, max(score) AS score, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM scored WHERE score >= {THRESHOLD} GROUP BY doc_id
)
SELECT d.doc_id, license, round(score, 6) AS score, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses FROM documents d LEFT JOIN agg USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2, "op5_license_scans": OP5, "op7_quality_rules": OP7, "op8_repeats": OP8}
