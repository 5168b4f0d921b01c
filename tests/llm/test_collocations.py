"""Collocations against plain counting of every phrase, and their SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from storelake.llm import collocations as co
from storelake.llm.automata import DEPTH, Automaton, levels, sorted_counts, union
from storelake.llm.oracles import ORACLES
from tests.llm.helpers import AWKWARD, documents


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", low)]


def slow(rows, least=30, top=2000):
    """rows: (lang, text)."""
    f, n = {}, Counter()
    for lang, text in rows:
        own = f.setdefault(lang or "und", Counter())
        for w in pieces_of(text):
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cands = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in cands.items():
            inside = [
                g for q, g in cands.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * g >= 80 * a for g in inside):
                continue
            cut = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-cut[0], -a, " ".join(p).encode(), own[p[: cut[1]]], own[p[cut[1] :]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def sample(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "é", "a\x01", "a", "x", "\U0001f600", "naïve", "und"]
    rows = []
    for _ in range(n):
        text = "".join(
            rng.choice(words if rng.random() < 0.7 else ["red Hot chili pepper", "new york city"])
            + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "! "])
            for _ in range(rng.randrange(60))
        )
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return rows


def frame(spark, rows):
    df = documents(spark, [(i, t) for i, (_, t) in enumerate(rows)])
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(rows)], "doc_id long, l2 string")
    return df.drop("lang").join(langs.withColumnRenamed("l2", "lang"), "doc_id")


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("size", [1 << 21, 500])
def test_matches_plain_counts_whatever_the_shards(spark, size):
    rows = [*sample(3), ("en", "one long " * 30_000), ("en", None), (None, "")]
    got = co.collocations(frame(spark, rows).repartition(5), shard_words=size, range_words=size)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == slow(rows)
    few = co.collocations(frame(spark, rows), least=60, top=7, shard_words=size, range_words=size)
    assert sorted(tuple(r) for r in few.collect()) == slow(rows, 60, 7)


def test_matches_sql(spark):
    rows = sample(8)
    df = frame(spark, rows)
    db = duckdb.connect()
    db.register("documents", df.select("lang", "text").toPandas())
    want = db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op12_collocations']})").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in co.collocations(df).collect()) == slow(rows)


def test_awkward_and_empty_tables(spark):
    df = documents(spark, AWKWARD)
    assert sorted(tuple(r) for r in co.collocations(df).collect()) == slow([("en", t) for _, t in AWKWARD])
    assert co.collocations(df.limit(0)).collect() == []


def test_automata_hold_unite_and_compose_counts():
    rng = np.random.default_rng(0)
    names = [f"w{i:02d}".encode() for i in range(12)]
    made, whole = [], Counter()
    for _ in range(5):
        windows = rng.integers(1, 13, (400, DEPTH)).astype(np.int32)
        for d in range(1, DEPTH):
            windows[rng.random(400) < 0.2, d:] = 0
        whole.update(map(tuple, windows.tolist()))
        a = Automaton.build(names, *sorted_counts(windows))
        back = Automaton.loads(a.dumps())
        assert [x.tolist() for x in back.arcs] == [x.tolist() for x in a.arcs]
        made.append(back)
    words, windows, weights = union(made)
    assert words == names
    assert dict(zip(map(tuple, windows.tolist()), weights.tolist(), strict=True)) == dict(whole)
    prefixes = Counter()
    for w, c in whole.items():
        for k in range(1, DEPTH + 1):
            if all(w[:k]):
                prefixes[w[:k]] += c
    for depth, (at, sums) in enumerate(levels(windows, weights), 1):
        found = dict(zip(map(tuple, windows[at, :depth].tolist()), sums.tolist(), strict=True))
        assert found == {p: c for p, c in prefixes.items() if len(p) == depth}
    text = {" ".join(names[i - 1].decode() for i in p): c for p, c in prefixes.items()}
    known = dict(list(text.items())[::3])  # not closed under beginnings
    asked = sorted(text)[::2]
    assert co.counts_of(asked, list(known), list(known.values())) == {
        p: known[p] for p in asked if p in known
    }


def test_equal_tails_are_one_state():
    words = sorted([b"a", b"b", b"c", b"d", b"x", b"y"])
    windows = np.array([[1, 2, 5, 6], [3, 4, 5, 6], [4, 4, 5, 6]], np.int32)
    a = Automaton.build(words, *sorted_counts(windows))
    assert [len(s) - 1 for s in a.starts] == [1, 2, 1, 1]
    assert sorted(map(tuple, a.windows()[0].tolist())) == sorted(map(tuple, windows.tolist()))


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "a b", big), ("en", "a", big + 1), ("en", "b", big + 2)], "lang string, phrase string, f long"
    )
    from pyspark.sql import functions as F

    cands = counts.withColumn("m", F.size(F.split("phrase", " "))).where("m > 1")
    (row,) = co._scored(counts, cands).collect()
    assert row.score == 2_000_000 * big // (2 * big + 3)
