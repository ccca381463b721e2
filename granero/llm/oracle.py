"""The SQL that the operators' queries must equal, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# The patterns of the contracts.
WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
WORD_RULE = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_MEASURED = f"""
base AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {WORDS} AS ws FROM documents
),
windows AS (
  SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS w
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM base WHERE len(ws) > 2)
),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS times FROM windows) WHERE times > 1
  ) GROUP BY r
),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
),
measured AS (
  SELECT base.r, doc_id, source,
    CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM base LEFT JOIN covered ON covered.r = base.r LEFT JOIN lines ON lines.r = base.r
)"""

# The prior's moments, per rule, as in the operator.
_RATES = """
ruled AS (
  SELECT *, n_words < 50 AS few, 100 * n_repeat_words > 50 * n_words AS rep,
    10 * n_symbols > word_chars AS signs, 5 * n_dup_lines > n_words AS dup
  FROM measured
),
counts AS (
  SELECT source, count(*) AS n, unnest([
    {'k': 1, 'x': count(*) FILTER (few)}, {'k': 2, 'x': count(*) FILTER (rep)},
    {'k': 3, 'x': count(*) FILTER (signs)}, {'k': 4, 'x': count(*) FILTER (dup)}]) AS f
  FROM ruled GROUP BY source
),
moments AS (
  SELECT f.k AS k, sum(n) AS total, avg(1.0 / n) AS inverse, var_pop(f.x / n) AS spread,
    least(greatest(sum(f.x) / sum(n), 1e-6), 1 - 1e-6) AS m
  FROM counts GROUP BY f.k
),
priors AS (
  SELECT k, m, least(greatest(CASE WHEN spread - m * (1 - m) * inverse > 0
    THEN m * (1 - m) / (spread - m * (1 - m) * inverse) - 1 ELSE total END, 1e-3), greatest(total, 1)) AS s
  FROM moments
),
bad AS (
  SELECT DISTINCT source FROM counts JOIN priors ON counts.f.k = priors.k
  WHERE (f.x + m * s) / (n + s) > 0.5
)"""

ORACLE["op2_host_quality_rules"] = f"""
WITH {_MEASURED}, {_RATES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR rep AS base_failed,
  host_rejected, NOT (few OR rep) AND NOT host_rejected AS kept
FROM (SELECT *, EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM ruled.source) AS host_rejected
      FROM ruled)
"""

ORACLE["op3_weighted_source_mix"] = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS signs,
    (CAST(CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
      + 0.5) / 4503599627370496.0 AS u
  FROM documents
),
keyed AS (
  SELECT *, -ln(u) / CASE WHEN size > 0 THEN CAST(size AS DOUBLE) / (CAST(size AS DOUBLE) + signs) ELSE 1 END AS k
  FROM sized
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM keyed GROUP BY source
),
shares AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
      ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM sources
),
plan AS (
  SELECT source, source_size, least(max(share) OVER () * w, CAST(3 * source_size AS DOUBLE)) AS target FROM shares
),
ordered AS (
  SELECT keyed.*, source_size, target,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY keyed.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after
  FROM keyed JOIN plan ON keyed.source IS NOT DISTINCT FROM plan.source
)
SELECT doc_id, size, source_size, target, source,
  CAST(size * (epochs + CASE WHEN 2 * after - size < 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) AS BIGINT)
    AS taken
FROM ordered
"""


def _license_sql() -> str:
    from granero.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    templates = ", ".join(
        f"('{name}', list_distinct(regexp_extract_all({lower.format(repr(text))}, '{WORD_RULE}')))"
        for name, text in TEMPLATES.items()
    )
    phrases = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in PHRASES.items())
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, {lower.format("coalesce(text, '')")} AS t FROM documents
),
worded AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD_RULE}') AS ws FROM base),
places AS (
  SELECT r, label, i FROM (
    SELECT r, ws, label, phrase, unnest(range(1, len(ws) - len(phrase) + 2)) AS i
    FROM worded CROSS JOIN (VALUES {phrases}) p(label, phrase) WHERE list_has_all(ws, phrase)
  ) WHERE ws[i:i + len(phrase) - 1] = phrase
),
based AS (
  SELECT r, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS z, list(DISTINCT label) AS names FROM places GROUP BY r
),
lines AS (
  SELECT r, regexp_extract_all(unnest(string_split(t, chr(10))), '{WORD_RULE}') AS ws FROM base
),
matched AS (
  SELECT r, name, len(list_intersect(template, ws)) / len(template) AS share
  FROM lines CROSS JOIN (VALUES {templates}) x(name, template)
  WHERE len(list_intersect(template, ws)) >= {THRESHOLD} * len(template) - 1e-9
),
scored AS (SELECT r, max(share) AS best, list(DISTINCT name) AS names FROM matched GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(based.n, 0) AS BIGINT) AS n_base,
  based.a AS first_word, based.z AS last_word,
  coalesce(array_to_string(list_sort(based.names), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(based.names, scored.names))), ','), '') AS labels,
  CASE WHEN based.n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM worded LEFT JOIN based ON based.r = worded.r LEFT JOIN scored ON scored.r = worded.r
"""


ORACLE["op4_license_scan"] = _license_sql()

ORACLE["op7_line_dedup"] = """
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
),
numbered AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM numbered
),
shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3
),
judged AS (
  SELECT keyed.*, shared.k IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

# The line rule, the marks and the seed of the contract.
ORACLE["op11_displacement_scatter"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
),
numbers AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || digest[1:8] AS BIGINT) % (len(u) + 1) AS a,
    CAST('0x' || digest[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CAST('0x' || digest[25:32] AS BIGINT) % 100 AS side
  FROM drawn
),
parts AS (
  SELECT doc_id, t, n, side,
    array_to_string(u[1:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain
  FROM numbers
)
SELECT doc_id, n,
  CASE WHEN plain THEN 'plain' WHEN side < 50 THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN NOT plain THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN side < 50 THEN '<S>' || s || '<P>' || p || '<M>' || m
    ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""

# The anchors, labels, scale and window of the contract.
ORACLE["op12_split_point_negatives"] = """
WITH given AS (
  SELECT vec_id,
    CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
usual AS (SELECT len(v) AS d FROM given GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1),
rows_ AS (
  SELECT vec_id, r.label AS label, r.v AS v
  FROM (SELECT vec_id, min({'label': label, 'v': v}) AS r FROM given, usual WHERE len(v) = d GROUP BY 1)
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
mined AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT * FROM mined WHERE rank <= 3"""
