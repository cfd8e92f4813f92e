"""DuckDB SQL for the queries of this package that SQL can express.

The others have no SQL: fitted models (1, 2), tokenizers (4, 7), span places
and a classifier (5), HTML trees (6) and XXH64 fingerprints (9).  Tests hold
those against brute force, the libraries, or held-out accuracy.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

_DECONTAMINATION = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM.format(_LOWER.format('text'))} AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item, l, array_to_string(ws[s:s + l - 1], ' ') AS k FROM (
    SELECT item, ws, least(13, len(ws)) AS l, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS s FROM i WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM.format(_LOWER.format('text'))} AS ws FROM documents),
dw AS (
  SELECT rid, s, l, array_to_string(ws[s:s + l - 1], ' ') AS k FROM (
    SELECT rid, ws, l, unnest(range(1, len(ws) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM iw))),
h AS (SELECT dw.rid, dw.s, dw.l, iw.item FROM dw JOIN iw ON dw.l = iw.l AND dw.k = iw.k),
p AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(s, s + l)) AS place FROM h) GROUP BY rid),
f AS (SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(p.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
       sha256(coalesce(f.items, '')) AS items_sha256, coalesce(p.n, 0) > 0 AND 20 * coalesce(p.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN f USING (rid)"""

_RULES = f"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
k AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (
  SELECT rid, count(DISTINCT place) AS n FROM (
    SELECT rid, unnest(range(i, i + 5)) AS place FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM k) WHERE c > 1)
  GROUP BY rid),
l AS (
  SELECT rid, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM w),
m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w JOIN l USING (rid) LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS INT)) AS f FROM b WHERE source IS NOT NULL GROUP BY source),
a AS (SELECT count(*) AS h, sum(n) AS n, sum(f) / sum(n) AS mean FROM hosts),
s AS (
  SELECT any_value(a.mean) AS mean, any_value(a.mean * (1 - a.mean)) AS noise,
         sum(hosts.n * (f / hosts.n - a.mean) ** 2) / any_value(a.n) - any_value(a.mean * (1 - a.mean) * a.h / a.n) AS excess
  FROM hosts, a),
prior AS (SELECT mean, CASE WHEN excess <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, noise / excess - 1)) END AS strength FROM s),
p AS (SELECT source, mean, n + strength AS weight, (f + mean * strength) / (n + strength) AS rate FROM hosts, prior),
bad AS (SELECT source AS host FROM p WHERE rate - 1.96 * sqrt(rate * (1 - rate) / (weight + 1)) > 1.5 * mean)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (host IS NOT NULL AND (100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 10 * n_words)) AS kept
FROM b LEFT JOIN bad ON b.source = bad.host"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(sha, {1 + 5 * g}, 5) AS BIGINT) >> {shift}) & 31 AS INT) + 1, 1)"
    for g in range(8)
    for shift in (15, 10, 5, 0)
)
_ARCHIVES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT body AS b, min(page_id) AS first_id FROM p GROUP BY body),
r AS (SELECT p.*, first_id, first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS revisit FROM p JOIN f ON p.body = f.b)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN first_id END AS refers_to
FROM r"""

_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, r.rid, r.vec_id, a.label = r.label AS same,
         CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON r.vec_id IS DISTINCT FROM a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, anchor_id, rid AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id NULLS LAST) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""

ORACLE: dict[str, str] = {
    "op3_benchmark_decontamination": _DECONTAMINATION,
    "op8_quality_rules": _RULES,
    "op10_warc_archives": _ARCHIVES,
    "op11_hard_negatives": _NEGATIVES,
}
