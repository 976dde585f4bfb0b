"""Expected results of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from paystream.llm import license, quality
from paystream.llm.queries import BLOCKED_DOMAINS, URL_RULES

ORACLES: dict[str, str] = {}

# DuckDB's regular expressions are RE2; the class is written for both.
_BLANK = r"[\x20\x09-\x0D]"


def _strings(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_SIGNATURES = ", ".join(
    f"({n}, '{r.keyword}', '{license.expression(r)}', '{r.label}', {r.priority}, {license.CONFIDENCE[r.priority]}::DOUBLE, {r.base})"
    for n, r in enumerate(license.RULES)
)
ORACLES["op1_license_scan"] = rf"""
WITH rules(n, keyword, pattern, label, priority, score, base) AS (VALUES {_SIGNATURES}),
d AS (SELECT doc_id, list_filter(string_split(regexp_replace({_lower("coalesce(text, '')")}, '{license.BETWEEN_WORDS}', ' ', 'g'), ' '),
  lambda x: x <> '') AS words FROM documents),
w AS (SELECT doc_id, words, unnest(range(len(words))) AS start FROM d),
h AS (SELECT doc_id, start, array_to_string(words[start + 1:start + {license.REACH}], ' ') AS context, r.*
  FROM w JOIN rules r ON words[start + 1] = keyword),
f AS (SELECT *, start + len(string_split(hit, ' ')) AS stop
  FROM (SELECT *, regexp_extract(context, pattern, 1) AS hit FROM h) WHERE hit <> ''),
k AS (SELECT * FROM f ANTI JOIN f AS e ON f.doc_id = e.doc_id AND e.start <= f.start AND e.stop >= f.stop
  AND (e.priority, f.stop - f.start - e.stop + e.start, e.n) < (f.priority, 0, f.n)),
b AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM f WHERE base GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM (
  SELECT doc_id, label, score FROM k UNION ALL SELECT doc_id, label, 0 FROM f WHERE base) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLES["op4_url_filter"] = f"""
WITH rules(h, p, v) AS (VALUES {_RULE_ROWS}),
urls AS (SELECT page_id, {_lower(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM urls JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches(host,
  '(^|\\.)({"|".join(d.replace(".", "[.]") for d in BLOCKED_DOMAINS)})$') THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN fit USING (page_id)
"""


def _rule_sql(r: quality.Rule) -> str:
    tests = [f"{r.metric} < {r.least}"] * (r.least is not None) + [f"{r.metric} > {r.most}"] * (r.most is not None)
    return f"(n_words >= {r.words} AND ({' OR '.join(tests)}))"


ORACLES["op7_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{_BLANK}+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
w AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM s WHERE len(words) >= 5),
g AS (SELECT doc_id, i, words[i:i+4] AS gram FROM w),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i+1, i+2, i+3, i+4]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(regexp_replace(text, '[^{quality.SYMBOLS}]', '', 'g')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(list_filter(words, lambda x: {_lower("x")} IN ({_strings(quality.STOP_WORDS)}))) AS n_stop, len(lines) AS n_lines,
  len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|…){_BLANK}*$'))) AS n_cut,
  len(list_filter(lines, lambda x: regexp_matches(x, '^{_BLANK}*[-*•]'))) AS n_bullet
  FROM s LEFT JOIN c USING (doc_id)),
q AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
  CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
  CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio,
  CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
  CASE WHEN n_lines > 0 THEN n_cut / n_lines ELSE 0 END AS ellipsis_line_ratio,
  CASE WHEN n_lines > 0 THEN n_bullet / n_lines ELSE 0 END AS bullet_line_ratio,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(_rule_sql(r) for r in quality.RULES)}) AS kept FROM q
"""

ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, nullif(first, page_id) AS refers_to FROM f
"""

ORACLES["op8_minhash"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_lower("coalesce(text, '')")}, '{_BLANK}+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
  ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS sh FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.sh) + len(y.sh) - n)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.other = u.a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""

ORACLES["op5_substring_dedup"] = rf"""
WITH s AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANK}+'), lambda x: x <> '') AS words FROM documents),
w AS (SELECT doc_id, i, words[i:i + 12] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM s WHERE len(words) >= 13)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM w) WHERE least < doc_id),
r AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM m)),
k AS (SELECT doc_id, count(*) AS n, list(p) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM s LEFT JOIN k USING (doc_id)
"""

ORACLES["op12_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS digest,
  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
h AS (SELECT *, len(units) AS n, [('0x' || digest[8 * k + 1:8 * k + 8])::BIGINT for k in range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
    THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
  array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
