from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelake.llm import crf, quality
from tests.llm.helpers import AWKWARD, documents


def paths(chain, emit):
    labels = range(emit.shape[1])
    for path in itertools.product(labels, repeat=len(emit)):
        score = sum(emit[i, y] for i, y in enumerate(path))
        yield path, score + sum(chain.steps[a, b] for a, b in zip(path, path[1:], strict=False))


def test_chain_equals_all_paths():
    rng = np.random.default_rng(0)
    chain = crf.Chain(np.zeros((1, 3)), rng.normal(size=(3, 3)))
    lengths = np.array([3, 1, 5, 2])
    emit = rng.normal(size=(lengths.sum(), 3))
    marginals, edges, total = chain.marginals(emit, lengths, edges=True)
    best = chain.viterbi(emit, lengths)
    at, want_total, want_edges = 0, 0.0, np.zeros((3, 3))
    for n in lengths:
        found = list(paths(chain, emit[at : at + n]))
        z = sum(np.exp(s) for _, s in found)
        want_total += np.log(z)
        want = np.zeros((n, 3))
        for path, s in found:
            for i, y in enumerate(path):
                want[i, y] += np.exp(s) / z
            for a, b in zip(path, path[1:], strict=False):
                want_edges[a, b] += np.exp(s) / z
        assert marginals[at : at + n] == pytest.approx(want)
        assert tuple(best[at : at + n]) == max(found, key=lambda x: x[1])[0]
        at += n
    assert total == pytest.approx(want_total) and edges == pytest.approx(want_edges)


def sample(n, seed):
    rng = random.Random(seed)
    words = "the river runs under a stone bridge and the old mill stands still".split()
    out = []
    for i in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(6, 30))) + "." for _ in range(4)]
        if i % 2:
            for k in range(1, rng.randrange(2, 4)):
                lines[k] = " ".join(w + "###" for w in lines[k].upper().split())
        out.append(("\n".join(lines), 1 - i % 2))
    return out


def test_held_out_accuracy_and_good_lines_of_bad_documents():
    model = quality.fit(sample(120, 1))
    test = sample(100, 2)
    got = model.scores([t.encode() for t, _ in test]) >= 0.7
    assert sum(g == bool(y) for g, (_, y) in zip(got, test, strict=True)) >= 98
    text = next(t for t, y in test if y == 0).encode()
    x, lengths, _ = quality.features([text])
    good = model.chain.marginals(x @ model.chain.weights, lengths)[:, quality.GOOD]
    assert good[0] > 0.5 > good[1]  # the first line is as good as any


def test_neighbours_stay_inside_a_document():
    both, _, _ = quality.features([b"one two", b"THREE ### ###\nfour"])
    alone, _, _ = quality.features([b"THREE ### ###\nfour"])
    assert np.array_equal(both[1:], alone)


def test_rows(spark):
    model = quality.fit(sample(60, 1))
    docs = documents(spark, AWKWARD)
    rows = quality.score(docs, model, F.lit(True)).collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    good = sorted(str(r.doc_id) for r in rows if r.predicted)
    assert sorted(str(r.doc_id) for r in kept.collect()) == good
    assert quality.score(docs.limit(0), model, F.lit(True)).count() == 0
    schema = "doc_id long, quality int, toxic int"
    only_good = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (None, 0, 0)], schema)
    assert {r.predicted for r in quality.quality_scores(docs, only_good).collect()} == {1}
