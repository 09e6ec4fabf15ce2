"""DuckDB SQL for the rows of those queries that SQL can express."""

from papyra.llm import mixing, risk_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

WARC = r"""
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda b: (substr(bits, 1 + 5 * k + b, 1)::INT) * (1 << (4 - b)::INT)))::INT, 1)), '') AS payload_digest
  FROM (SELECT *, array_to_string(list_transform(range(1, 41), lambda k: substr(((instr('0123456789abcdef', substr(hex, k, 1)) - 1)::INT + 16)::BIT::VARCHAR, 29, 4)), '') AS bits FROM p)),
g AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, CASE WHEN url IS NULL THEN NULL ELSE url END AS url, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM g
"""

SUBSTRINGS = rf"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
win AS (SELECT doc_id, unnest(list_transform(range(greatest(len(w) - 49, 0)), lambda i: sha256(array_to_string(w[i + 1:i + 50], ' ')))) AS h, unnest(range(greatest(len(w) - 49, 0))) AS p FROM docs),
low AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
hits AS (SELECT doc_id, p FROM win JOIN low USING (h) WHERE doc_id > first),
gone AS (
  SELECT doc_id, p, word, coalesce(max(h) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM (SELECT w.doc_id, w.p, w.word, CASE WHEN x.p IS NOT NULL THEN 1 END AS h FROM word w LEFT JOIN hits x ON x.doc_id = w.doc_id AND x.p = w.p)),
kept AS (SELECT doc_id, count(*) FILTER (WHERE gone = 1) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0), '') AS text FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)
"""

_RATES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)::DOUBLE",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)::DOUBLE",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)::DOUBLE",
    "mean_chars_high": "word_chars / greatest(n_words, 1)::DOUBLE",
    "mean_chars_low": "-word_chars / greatest(n_words, 1)::DOUBLE",
}
_GRID = ", ".join(f"('{rule}', {cutoff}::DOUBLE)" for rule, cutoffs in risk_rules.GRID.items() for cutoff in cutoffs)
_VALUES = " UNION ALL ".join(f"SELECT row, stratum, '{rule}' AS rule, {value} AS value FROM f" for rule, value in _RATES.items())


def rules(risk: float = risk_rules.RISK, delta: float = risk_rules.DELTA) -> str:
    p = risk / len(risk_rules.GRID)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '(none)') AS stratum, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (SELECT row, unnest(list_transform(range(greatest(len(w) - 4, 0)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS win, unnest(range(greatest(len(w) - 4, 0))) AS p FROM d),
twice AS (SELECT row, p, count(*) OVER (PARTITION BY row, win) AS n FROM win),
spans AS (SELECT row, least(5, coalesce(lead(p) OVER (PARTITION BY row ORDER BY p) - p, 5)) AS n FROM twice WHERE n > 1),
rep AS (SELECT row, sum(n) AS n FROM spans GROUP BY row),
f AS (
  SELECT d.row, doc_id, stratum, text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d) d LEFT JOIN rep ON rep.row = d.row),
rated AS (SELECT *, n_words < {risk_rules.MIN_WORDS} OR 100 * n_repeat_words > {risk_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f),
vals AS ({_VALUES}),
known AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)),
each AS (SELECT row, stratum, md5(text) AS text, quality FROM rated JOIN known USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY md5(text), stratum) = 1),
trials AS (SELECT min(row) AS row, max(quality) AS quality FROM each GROUP BY stratum, text HAVING min(quality) = max(quality)),
grid(rule, cutoff) AS (VALUES {_GRID}),
counts AS (
  SELECT v.stratum, v.rule, cutoff, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE quality = 1 AND value > cutoff) AS false_rejected, count(*) FILTER (WHERE quality = 0) AS bad, count(*) FILTER (WHERE quality = 0 AND value > cutoff) AS rejected
  FROM vals v JOIN rated USING (row) JOIN trials USING (row) JOIN grid USING (rule) WHERE NOT base_failed GROUP BY v.stratum, v.rule, cutoff),
cdf AS (
  SELECT *, list_sum(list_transform(range(false_rejected + 1), lambda i: exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({p!r}) + (good - i) * ln(1 - {p!r})))) AS p FROM counts WHERE false_rejected < good * {p!r}),
gains AS (SELECT *, round(rejected / greatest(bad, 1)::DOUBLE - false_rejected / good::DOUBLE, 9) AS gain FROM cdf WHERE p <= {delta}::DOUBLE / {len(risk_rules.GRID)} / (SELECT count(DISTINCT stratum) FROM counts)),
best AS (SELECT stratum, rule, arg_max(cutoff, (gain, cutoff)) AS cutoff FROM gains WHERE gain > 0 GROUP BY stratum, rule),
failed AS (SELECT DISTINCT row FROM vals JOIN best USING (stratum, rule) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND row NOT IN (SELECT row FROM failed) AS kept FROM rated
"""

ORACLE_SQL = {
    "op1_warc_round_trip": WARC,
    "op2_capped_water_filling_mix": mixing.ORACLE_SQL,
    "op7_superkmer_substring_dedup": SUBSTRINGS,
    "op10_risk_controlled_quality_rules": rules(),
}
