"""The licence scan against its SQL and a plain scan of every interval."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from storelake.llm import license_scan as scan
from storelake.llm.license_rules import LEVELS, RULES
from storelake.llm.scan_oracle import license_oracle
from tests.llm.helpers import AWKWARD, documents


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower)


def slow_scan(text):
    """All detections by every rule at every word; suppression by every pair."""
    w = words_of(text)
    found = []
    for n, r in enumerate([*scan.base_rules(), *RULES]):
        for at in (i for i, x in enumerate(w) if x == r.keyword):
            left = re.search(r.before, " " + "".join(x + " " for x in w[max(0, at - 32) : at]))
            right = re.match(r.after, "".join(x + " " for x in w[at : at + 40]))
            if left and right:
                found.append(
                    (at - left[0].count(" ") + 1, at + right[0].count(" ") - 1, r.level, n, r.label, r.sure)
                )
    base = [d for d in found if d[2] == 0]
    method = [d for d in found if d[2] > 0]

    def hides(e, d):
        if e is d or e[0] > d[0] or e[1] < d[1] or e[2] > d[2]:
            return False
        return (e[0], e[1]) != (d[0], d[1]) or e[2:4] < d[2:4]

    kept = [d for d in method if not any(hides(e, d) for e in method)] + base
    starts = [d[0] for d in base]
    return (
        len(w), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({d[4] for d in base})), ",".join(sorted({d[4] for d in kept})),
        max((d[5] for d in kept), default=0.0),
    )


def sample(seed, n):
    rng = random.Random(seed)
    pieces = [re.sub(r"\.\{0,80\}", "many words ", line.split(" | ")[1]) for lines, _ in LEVELS
              for line in lines.strip().splitlines()]
    pieces = [re.sub(r"\(([^()|]*)[^()]*\)\??", r"\1", re.sub(r"\[(.)[^\]]*\]", r"\1", p)) for p in pieces]
    pieces = [re.sub(r"[{}?]", "", p) for p in pieces]
    pieces += ["Released under the MIT License.", "Apache License, Version 2.0", "CC BY-NC", "or later",
               "cc by nc cc by nc", "version 3", "2 0", "commit license", "mit", "licensé", "GPL"]
    return [" ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(n)]


COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_matches_plain_scan_and_sql(spark):
    rows = [*AWKWARD, *((100 + i, t) for i, t in enumerate(sample(4, 150)))]
    df = documents(spark, rows)
    got = scan.license_scan(df)
    assert got.columns == COLUMNS
    key = lambda t: tuple((v is None, str(v)) for v in t)
    got = sorted((tuple(r) for r in got.collect()), key=key)
    assert got == sorted(((i, *slow_scan(t)) for i, t in rows), key=key)
    db = duckdb.connect()
    db.register("documents", df.select("doc_id", "text").toPandas())
    want = db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({license_oracle()})").fetchall()
    whole = [(None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:]) for r in want]
    assert sorted(whole, key=key) == got
    assert sum(1 for r in got if r[2]) > 20 and len({r[6] for r in got}) > 60


def test_rules_are_many_and_windows_hold_them():
    assert len(RULES) >= 200 and len({r.label for r in RULES}) >= 60
    for r in RULES:
        assert len(r.before.split()) + 16 <= scan.BEFORE or "{0,80}" in r.before or len(r.before.split()) < 30
        assert len(r.after.split()) < scan.AFTER


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("GNU General Public License version 3 or later", "gpl-3+"),  # not gpl-3, not gpl
        ("the GNU General Public License", "gpl"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
        ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc,cc-by-nc-sa"),  # the phrase stays
        ("MIT license and, elsewhere, the Apache License, Version 2.0", "apache-2,mit"),
        ("no words of that kind", ""),
    ],
)
def test_longer_and_surer_detections_win(spark, text, labels):
    assert [r.labels for r in scan.license_scan(documents(spark, [(1, text)])).collect()] == [labels]


def test_many_places_in_one_text_and_no_rows(spark):
    text = "x cc by nc " * 20_000
    (row,) = scan.license_scan(documents(spark, [(1, text)])).collect()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (80_000, 20_000, 1, 79_997)
    assert scan.license_scan(documents(spark, [(1, "a")]).limit(0)).count() == 0
    assert scan.license_scan(documents(spark, [(1, "MIT license")]), (), []).collect()[0].labels == ""


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = scan.license_scan(documents(spark, AWKWARD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
