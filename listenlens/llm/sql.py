"""DuckDB SQL for the operators that SQL can express, written apart from the Spark side."""

from __future__ import annotations

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

# (kind, order, pattern, condition on the match m)
SECRET_KINDS = (
    ("assign", 0, ASSIGN, f"length(regexp_extract(m, '{ASSIGN}', 2)) >= 12"),
    ("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 18"),
    ("hex", 2, "[0-9a-f]+", "length(m) >= 16"),
    ("pem", 3, "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", "true"),
    ("jwt", 4, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", "true"),
    ("service", 5, "(?:ghp|gho|ghs|glpat|xoxb|xoxp)[_-][A-Za-z0-9-]{20,}", "true"),
)

_SECRET_PARTS = " UNION ALL ".join(f"""
    SELECT r, '{kind}' AS kind, {o} AS o, s, s + length(m) AS e FROM (
        SELECT r, m, list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT
                     + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s
        FROM (SELECT r, h, g, unnest(range(1, len(h) + 1)) AS i, unnest(h) AS m
              FROM (SELECT r, regexp_extract_all(t, '{p}') AS h, string_split_regex(t, '{p}') AS g FROM d))) x
    WHERE {cond}""" for kind, o, p, cond in SECRET_KINDS)

SECRET_SCAN = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_SECRET_PARTS}),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3) AS base,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
      FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)"""

QUALITY_RULES = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
      FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(8) AS k(k) GROUP BY r),
s AS (
    SELECT r, doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
           len(list_filter(list_zip(w, w[2:]), lambda x: x[1] = x[2])) AS n_stutters,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower
    FROM w LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
            OR 100 * n_stutters > 30 * n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR (upper * 10 > 4 * (upper + lower) AND upper + lower >= 20)) AS kept
FROM s"""

DECONTAMINATION = r"""
WITH i AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
           FROM benchmark WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, least(len(w), 5) AS n, array_to_string(w[k:k + least(len(w), 5) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS k FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
      FROM documents WHERE text IS NOT NULL),
n AS (SELECT DISTINCT n FROM ig),
dg AS (SELECT DISTINCT r, n, array_to_string(w[k:k + n - 1], ' ') AS s
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, n WHERE len(w) >= n)),
size AS (SELECT item_id, count(*) AS n_shingles FROM ig GROUP BY item_id),
hit AS (SELECT r, item_id, count(*) AS n_shared FROM dg JOIN ig USING (n, s) GROUP BY r, item_id)
SELECT doc_id, item_id, max(n_shared) AS n_shared, max(n_shingles) AS n_shingles,
       max(n_shared) / max(n_shingles) AS containment
FROM hit JOIN size USING (item_id) JOIN d USING (r)
WHERE n_shared >= 0.8 * n_shingles GROUP BY doc_id, item_id"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT h, max(page_id) AS keep FROM p WHERE octet_length(encode(h)) >= 1000 GROUP BY h)
SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN keep IS DISTINCT FROM page_id AND keep IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep IS DISTINCT FROM page_id THEN keep END AS refers_to
FROM p LEFT JOIN k USING (h)"""

COLLOCATIONS = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, m, w[i:i + m - 1] AS g
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 4) AS k(m) WHERE len(w) >= m)),
f AS (SELECT lang, m, g, count(*)::HUGEINT AS f FROM g GROUP BY lang, m, g),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, g, f AS a FROM f WHERE m > 1 AND f >= 10),
cut AS (SELECT c.lang, c.m, c.g, a, k, l.f AS l, r.f AS r, 1000000 * a * a // (l.f * r.f) AS score
        FROM c, range(1, 3) AS k(k), f AS l, f AS r
        WHERE k < c.m AND l.lang = c.lang AND l.g = c.g[1:k] AND r.lang = c.lang AND r.g = c.g[k + 1:c.m]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner2 AS (SELECT lang, g, max(a) AS longer
           FROM (SELECT lang, unnest([g[1:2], g[2:3]]) AS g, a FROM c WHERE m = 3) GROUP BY lang, g),
kept AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM low LEFT JOIN inner2 USING (lang, g)
         WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

ORACLES = {
    "op1_secret_scan": SECRET_SCAN,
    "op3_quality_rules": QUALITY_RULES,
    "op8_warc_zstd": WARC,
    "op10_decontamination": DECONTAMINATION,
    "op13_collocations": COLLOCATIONS,
}
