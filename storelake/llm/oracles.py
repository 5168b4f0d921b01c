"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from storelake.llm.scan_oracle import license_oracle

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR))) AS d
  FROM documents),
drawn AS (
  SELECT doc_id, source, size, CAST('0x' || substr(d, 1, 2) AS BIGINT) AS cell,
         CAST('0x' || substr(d, 3, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u
  FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM drawn GROUP BY source),
ordered AS (
  SELECT *, CAST(sum(s) OVER () AS BIGINT) AS total, CAST(sum(w) OVER () AS BIGINT) AS all_w,
         CAST(coalesce(sum(3 * s) OVER o, 0) AS BIGINT) AS s_before,
         CAST(coalesce(sum(w) OVER o, 0) AS BIGINT) AS w_before
  FROM sources
  WINDOW o AS (ORDER BY CAST(3 * s AS DOUBLE) / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
clamps AS (
  SELECT *, w * (total - s_before) > 3 * s * (all_w - w_before) AS clamped FROM ordered),
spread AS (
  SELECT *, CAST(total - coalesce(sum(3 * s) FILTER (clamped) OVER (), 0) AS BIGINT) AS left_s,
         CAST(all_w - coalesce(sum(w) FILTER (clamped) OVER (), 0) AS BIGINT) AS left_w
  FROM clamps),
targets AS (
  SELECT source, s AS source_size,
         CASE WHEN clamped THEN CAST(3 * s AS DOUBLE)
              ELSE CAST(w * left_s AS DOUBLE) / greatest(left_w, 1) END AS target
  FROM spread),
cells AS (
  SELECT source, cell, CAST(sum(size) AS BIGINT) AS held FROM drawn GROUP BY source, cell),
run AS (
  SELECT *, CAST(coalesce(sum(held) OVER (PARTITION BY source ORDER BY cell
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bef FROM cells),
plan AS (
  SELECT r.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT)
              ELSE 0 END AS whole
  FROM run r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(p.whole * d.size + floor(d.size * (CASE WHEN p.held = 0 THEN 0.0::DOUBLE ELSE
         greatest(0.0::DOUBLE, least(1.0::DOUBLE,
           (p.target - p.whole * p.source_size - p.bef) / p.held)) END) + d.u) AS BIGINT) AS taken
FROM drawn d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source AND d.cell = p.cell
"""

_EXACT = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g USING (text)
"""

_TOP = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_KEPT = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS rid, vec_id, label, q
  FROM (SELECT vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)),
parts AS MATERIALIZED (
  SELECT rid, pos, (pos - 1) // (n // 8) AS part, q[pos] AS x
  FROM (SELECT rid, q, len(q) AS n, unnest(range(1, len(q) + 1)) AS pos FROM kept)),
book0 AS MATERIALIZED (
  SELECT rid - 1 AS entry, part, pos, x AS c FROM parts WHERE rid <= 16)"""

# Distances, nearest entries and means of one round; the last round has no means.
_NEAREST = """,
far{r} AS (
  SELECT p.rid, p.part, b.entry, sum((p.x - b.c) * (p.x - b.c)) AS d
  FROM parts p JOIN book{r} b USING (pos) GROUP BY ALL),
near{r} AS MATERIALIZED (
  SELECT rid, part, min(d) AS d, arg_min(entry, d * 16 + entry) AS entry FROM far{r} GROUP BY ALL)"""
_MEANS = """,
sums{r} AS (
  SELECT n.part, n.entry, p.pos, sum(p.x) AS s, count(*) AS n
  FROM near{r} n JOIN parts p USING (rid, part) GROUP BY ALL),
book{next} AS MATERIALIZED (
  SELECT b.entry, b.part, b.pos,
         CASE WHEN s.n IS NULL THEN b.c ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS c
  FROM book{r} b LEFT JOIN sums{r} s USING (part, entry, pos))"""
_CODED = """,
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d) AS error
  FROM near6 GROUP BY rid),
totals AS (SELECT label, sum(error) AS label_error FROM coded JOIN kept USING (rid) GROUP BY label),
digest AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM book6)
SELECT k.vec_id, c.code, CAST(c.error AS BIGINT) AS error,
       CAST(t.label_error AS BIGINT) AS label_error, codebooks_sha256
FROM coded c JOIN kept k USING (rid) JOIN totals t ON k.label IS NOT DISTINCT FROM t.label, digest
"""
_CODES = (
    _KEPT
    + "".join(_NEAREST.format(r=r) + _MEANS.format(r=r, next=r + 1) for r in range(6))
    + _NEAREST.format(r=6)
    + _CODED
)

_PHRASES = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT piece, lang, unnest(w) AS word, unnest(range(len(w))) AS pos FROM numbered),
runs AS MATERIALIZED (
  SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3,
         lead(word, 3) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY piece ORDER BY pos)),
f AS MATERIALIZED (
  SELECT lang, phrase, count(*) AS f, len(string_split(phrase, ' ')) AS m FROM (
    SELECT lang, w1 AS phrase FROM runs
    UNION ALL SELECT lang, w1 || ' ' || w2 FROM runs
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 FROM runs
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs)
  WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
sizes AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT lang, phrase, f AS a, m, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
starts AS (
  SELECT lang, a, m, w, unnest(range(1, m)) AS s FROM candidates WHERE m > 2),
inside AS (
  SELECT lang, a, array_to_string(w[s : e], ' ') AS part
  FROM (SELECT lang, a, m, w, s, unnest(range(s + 1, m + 1)) AS e FROM starts)
  WHERE e - s + 1 < m),
covers AS (SELECT lang, part, max(a) AS a FROM inside GROUP BY ALL),
open AS (
  SELECT c.* FROM candidates c LEFT JOIN covers v ON c.lang = v.lang AND c.phrase = v.part
  WHERE v.a IS NULL OR 100 * CAST(v.a AS HUGEINT) < 80 * CAST(c.a AS HUGEINT)),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM open),
counted AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         (2000000 * CAST(c.a AS HUGEINT)) // (x.f + y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.m], ' ')),
best AS (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r.r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN sizes s ON r.lang = s.lang WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op4_ball_tree_top_k": _TOP,
    "op6_mix_sources": _MIX,
    "op7_exact_dedup": _EXACT,
    "op11_vector_codes": _CODES,
    "op12_collocations": _PHRASES,
    "op13_license_scan": license_oracle(),
}
