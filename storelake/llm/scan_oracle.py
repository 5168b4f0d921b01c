"""DuckDB SQL of the licence scan: anchors as rows, rules by join, suppression by windows."""

from __future__ import annotations

from storelake.llm.license_rules import LEVELS, RULES
from storelake.llm.license_scan import AFTER, BEFORE, LOWER, SCAN_WORD, UPPER, base_rules


def _quoted(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def license_oracle() -> str:
    rules = ",\n  ".join(
        "(" + ", ".join(map(_quoted, (r.level, n, r.label, r.keyword, r.before, r.after, r.sure))) + ")"
        for n, r in enumerate([*base_rules(), *RULES])
    )
    # Detections that start earlier, or as early and end later, or have the same words
    # and come first by level and number.
    earlier = "PARTITION BY rid ORDER BY a0, z0 DESC, level, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    reach = " ".join(
        f"WHEN {p} THEN max(CASE WHEN level <= {p} THEN z0 END) OVER ({earlier})"
        for p in range(1, len(LEVELS) + 1)
    )
    return f"""
WITH rules(level, number, label, keyword, before, after, sure) AS (VALUES
  {rules}),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SCAN_WORD}') AS w
  FROM documents),
words AS MATERIALIZED (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs),
anchors AS MATERIALIZED (
  SELECT rid, pos, word FROM words WHERE word IN (SELECT keyword FROM rules)),
around AS (
  SELECT rid, pos, word, unnest(range(pos - {BEFORE}, pos + {AFTER})) AS near FROM anchors),
windows AS (
  SELECT a.rid, a.pos, a.word,
         ' ' || coalesce(string_agg(x.word || ' ', '' ORDER BY x.pos) FILTER (x.pos < a.pos), '') AS lhs,
         string_agg(x.word || ' ', '' ORDER BY x.pos) FILTER (x.pos >= a.pos) AS rhs
  FROM around a JOIN words x ON a.rid = x.rid AND a.near = x.pos
  GROUP BY a.rid, a.pos, a.word),
tried AS (
  SELECT a.rid, a.pos, r.level, r.number, r.label, r.sure,
         regexp_extract(a.lhs, r.before) AS l, regexp_extract(a.rhs, r.after) AS m
  FROM windows a JOIN rules r ON a.word = r.keyword),
found AS (
  SELECT rid, level, number, label, sure,
         pos - (length(l) - length(replace(l, ' ', ''))) + 1 AS a0,
         pos + (length(m) - length(replace(m, ' ', ''))) - 1 AS z0
  FROM tried WHERE l <> '' AND m <> ''),
base AS (
  SELECT rid, count(*) AS n_base, min(a0) AS first_word, max(a0) AS last_word,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels
  FROM found WHERE level = 0 GROUP BY rid),
reached AS (
  SELECT *, CASE level {reach} END AS reach FROM found WHERE level > 0),
kept AS (
  SELECT rid, label, sure FROM reached WHERE reach IS NULL OR reach < z0
  UNION ALL SELECT rid, label, sure FROM found WHERE level = 0),
named AS (
  SELECT rid, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(sure) AS score
  FROM kept GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base,
       CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
       coalesce(b.base_labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
       CAST(coalesce(n.score, 0) AS DOUBLE) AS score
FROM docs d LEFT JOIN base b USING (rid) LEFT JOIN named n USING (rid)
"""
