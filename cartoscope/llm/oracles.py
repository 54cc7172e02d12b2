"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .lines import LOWER, UPPER
from .quality import CUTOFFS

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
"""

_RULES = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "word_length": ("word_chars", "n_words")}
_GRID = ", ".join(f"('{r}', {c!r}::DOUBLE)" for r, cs in CUTOFFS.items() for c in cs)
_RATE = 0.02 / len(CUTOFFS)
_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, lang, base_failed, '{r}' AS rule, CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0 END AS value FROM base" for r, (a, b) in _RULES.items()
)

QUALITY = f"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
tok AS (SELECT doc_id, unnest(ws) AS a, unnest(range(len(ws))) AS i FROM w),
tri AS (SELECT doc_id, i, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c FROM tok WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(3)) AS k) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS ls FROM w),
counts AS (SELECT doc_id, lang, len(ws) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM w JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
vals AS ({_VALUES}),
grid AS (SELECT * FROM (VALUES {_GRID}) g(rule, cut)),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
tests AS (SELECT lang, rule, cut, count(*) AS n, count(*) FILTER (WHERE value > cut) AS k FROM vals JOIN good USING (doc_id) JOIN grid USING (rule) GROUP BY lang, rule, cut),
ps AS (SELECT *, CASE WHEN k > n * {_RATE!r} THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda i:
  exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RATE!r}) + (n - i) * ln(1 - {_RATE!r})))) END AS p FROM tests),
cuts AS (SELECT lang, rule, min(cut) AS cut FROM ps WHERE p * (SELECT count(*) FROM tests) <= 0.05 GROUP BY lang, rule),
hit AS (SELECT DISTINCT doc_id FROM vals JOIN cuts ON vals.rule = cuts.rule AND vals.lang IS NOT DISTINCT FROM cuts.lang WHERE value > cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND hit.doc_id IS NULL AS kept
FROM base LEFT JOIN hit USING (doc_id)
"""

ORACLES: dict[str, str] = {"op6_risk_controlled_rules": QUALITY, "op8_line_runs": LINES}
