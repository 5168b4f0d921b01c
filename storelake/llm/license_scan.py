"""Licence scan by ordered signature rules, in SQL functions only.

A text becomes its words. Words that are some rule's keyword are its anchors; a text
without any is done at that point. Around each anchor a window of words is cut, and the
rules of that keyword are tried there: one expression must end at the anchor, the other
begin with it. So the work grows with the number of words and of anchors, however long a
text is. Detections are intervals of words. One is suppressed when another of the same or
a higher level contains it (of equal intervals at one level, the earlier rule's stays).
That takes one sweep in order of start over the largest end so far of each level.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import text_of
from storelake.llm.license_rules import LEVELS, RULES, Rule

#: Letters and digits of ASCII, and everything beyond ASCII.
SCAN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window before and from the anchor; no rule is longer.
BEFORE, AFTER = 32, 40
#: How sure a place of a plain phrase is.
PHRASE_SURE = 0.85


class Phrase(NamedTuple):
    """Plain words to find in a row, with the word to look for first in braces."""

    words: str
    label: str


BASE = (
    Phrase("under the {mit} license", "mit"),
    Phrase("{apache} license version 2", "apache-2"),
    Phrase("{cc} by nc", "cc-by-nc"),
)


def base_rules(phrases: tuple[Phrase, ...] = BASE) -> list[Rule]:
    """The phrases as rules of level 0, which nothing suppresses."""
    out = []
    for p in phrases:
        before, keyword, after = re.fullmatch(r"(.*)\{(\S+)\}(.*)", p.words).groups()
        escaped = [re.escape(x) for x in (before.strip(), f"{keyword}{after}".strip())]
        before, after = (x.replace(r"\ ", " ") + " " * bool(x) for x in escaped)
        out.append(Rule(0, p.label, keyword, f" (?:{before})$", f"^{after}", PHRASE_SURE))
    return out


def _constant(rules: list[Rule]) -> Column:
    """The rules as one constant array."""
    return F.array(
        *[
            F.struct(
                F.lit(r.level).alias("level"),
                F.lit(number).alias("number"),
                F.lit(r.label).alias("label"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.before).alias("before"),
                F.lit(r.after).alias("after"),
                F.lit(r.sure).alias("sure"),
            )
            for number, r in enumerate(rules)
        ]
    ).cast(
        "array<struct<level:int,number:int,label:string,keyword:string,before:string,after:string,sure:double>>"
    )


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _found(rules: list[Rule]) -> Column:
    """The detections at the anchors of ``_windows``, unordered."""
    known = _constant(rules)

    def tried(w: Column) -> Column:
        return F.transform(
            F.filter(known, lambda r: r.keyword == w.word),
            lambda r: F.struct(
                w.at.alias("at"),
                F.regexp_substr(w.before, r.before).alias("left"),
                F.regexp_substr(w.after, r.after).alias("right"),
                r.alias("rule"),
            ),
        )

    both = F.filter(
        F.flatten(F.transform("_windows", tried)),
        lambda t: t.left.isNotNull() & t.right.isNotNull(),
    )
    return F.transform(
        both,
        lambda t: F.struct(
            (t.at - _spaces(t.left) + 1).alias("first"),
            # Negative, so that of equal starts the longest comes first.
            (-(t.at + _spaces(t.right) - 1)).alias("minus_last"),
            t.rule.level.alias("level"),
            t.rule.number.alias("number"),
            t.rule.label.alias("label"),
            t.rule.sure.alias("sure"),
        ),
    )


def _resolved(found: Column, levels: int) -> Column:
    """(labels, sure) of the detections that no other suppresses; ``found`` is in order."""
    start = F.struct(
        F.array_repeat(F.lit(-1), levels).alias("ends"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("sure"),
    )

    def step(s: Column, d: Column) -> Column:
        last = -d.minus_last
        free = F.element_at(s.ends, d.level) < last
        return F.struct(
            F.transform(
                s.ends, lambda e, i: F.when(i + 1 >= d.level, F.greatest(e, last)).otherwise(e)
            ).alias("ends"),
            F.when(free, F.array_union(s.labels, F.array(d.label)))
            .otherwise(s.labels)
            .alias("labels"),
            F.when(free, F.greatest(s.sure, d.sure)).otherwise(s.sure).alias("sure"),
        )

    return F.aggregate(found, start, step)


def license_scan(
    docs: DataFrame,
    phrases: tuple[Phrase, ...] = BASE,
    rules: list[Rule] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    Words are of the lower-cased (A-Z) text. ``n_base`` counts all places of the phrases,
    overlapping ones included; ``first_word`` and ``last_word`` are their smallest and
    largest start (null without any). ``labels`` holds the phrases' labels and those of
    the rules' detections that are not suppressed, distinct, sorted by code point.
    ``score`` is how sure the surest of these is, 0 without any. A null text counts as
    empty. Every row is scanned for itself: repeated rows and ids give repeated results.
    """
    base = base_rules(phrases)
    rules = RULES if rules is None else rules
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in [*base, *rules]})])
    keywords = keywords.cast("array<string>")
    lowered = F.translate(text_of(text_col), UPPER, LOWER)
    words = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.regexp_extract_all(lowered, F.lit(SCAN_WORD), F.lit(0)).alias("_words"),
    )
    gated = words.withColumn("_present", F.array_intersect("_words", keywords))

    def window(a: Column) -> Column:
        start = F.greatest(a.at - BEFORE, F.lit(0))
        before = F.array_join(F.slice("_words", start + 1, a.at - start), " ")
        after = F.array_join(F.slice("_words", a.at + 1, F.lit(AFTER)), " ")
        return F.struct(
            a.at.alias("at"),
            a.word.alias("word"),
            F.when(a.at == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), before, F.lit(" "))).alias("before"),
            F.concat(after, F.lit(" ")).alias("after"),
        )

    numbered = F.transform("_words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    anchors = F.filter(numbered, lambda a: F.array_contains("_present", a.word))
    windows = F.when(F.size("_present") > 0, F.transform(anchors, window))
    found = F.when(F.size("_present") > 0, F.array_sort(_found([*base, *rules])))
    return (
        gated.withColumn("_windows", windows)
        .withColumn("_found", found)
        .withColumn("_base", F.filter("_found", lambda d: d.level == 0))
        .withColumn(
            "_kept", _resolved(F.filter("_found", lambda d: d.level > 0), max(len(LEVELS), 1))
        )
        .select(
            F.col("_id").alias(id_col),
            F.size("_words").cast("long").alias("n_words"),
            F.coalesce(F.size("_base"), F.lit(0)).cast("long").alias("n_base"),
            F.array_min("_base.first").cast("long").alias("first_word"),
            F.array_max("_base.first").cast("long").alias("last_word"),
            _sorted_labels(F.col("_base.label")).alias("base_labels"),
            _sorted_labels(F.concat("_base.label", "_kept.labels")).alias("labels"),
            F.coalesce(
                F.greatest(F.col("_kept.sure"), F.array_max("_base.sure")), F.lit(0.0)
            ).alias("score"),
        )
    )


def _sorted_labels(labels: Column) -> Column:
    return F.coalesce(F.array_join(F.array_sort(F.array_distinct(labels)), ","), F.lit(""))
