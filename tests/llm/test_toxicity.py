from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from storelake.llm import toxicity as tox
from tests.llm.helpers import AWKWARD, documents

SEEDS = tox.Lexicon({"vile": 4.0}, {"grub": 3.0})


@pytest.mark.parametrize(
    ("text", "scores"),
    [
        ("", []), ("a fine day", []), ("a vile day", [4.0]),
        ("you vile one", [5.0]),  # a target before it weighs more
        ("not a vile one", [0.2]), ("not in any way at all vile", [4.0]),  # three words of reach
        ("he said it is vile", [0.75]), ("he said so. vile", [4.0]),  # a clause ends a report
        ("vile vile. ok. Grubbing", [8.0, 3.0]), ("I kill you", [2.0]), ("I kill time", []),
        ("you wait, I hurt them", [2.0]), ("do not hurt you", [0.1]), ("VILE!\nvile", [4.0, 4.0]),
    ],
)
def test_clauses(text, scores):
    assert tox.clause_scores(text.encode(), SEEDS) == pytest.approx(scores)


def test_composition_equals_machines_in_a_row():
    machines = [
        tox._machine(4, tox._negation), tox._machine(2, tox._reported),
        tox._machine(2, tox._targeted), tox._machine(3, tox._threat), tox._machine(1, tox._insult),
    ]
    rng = random.Random(0)
    state, states = 0, [0] * len(machines)
    for _ in range(2000):
        symbol = rng.randrange(tox.SYMBOLS)
        state, out, weight = tox.GRAMMAR.arcs[state][symbol]
        product, read = 1.0, symbol
        for i, m in enumerate(machines):
            states[i], read, w = m.arcs[states[i]][read]
            product *= w
        assert (out, weight) == (read, pytest.approx(product))


def sample(n, seed):
    rng = random.Random(seed)
    words = ["river", "stone", "walks", "green", "light", "under", "table", "often", "never"]
    out = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if i % 2:
            text.insert(rng.randrange(len(text)), rng.choice(["zorky", "brelfan", "brelfix", "brelfos"]))
        out.append((" ".join(text) + ".", i % 2))
    return out


def test_learns_words_and_held_out_accuracy(spark):
    train, test = sample(400, 1), sample(200, 2)
    model = tox.fit(train)
    assert "zorky" in model.lexicon.words and "brelf" in model.lexicon.starts
    assert not set(model.lexicon.words) & {"river", "never"}
    got = model.scores([t.encode() for t, _ in test]) >= 0.5
    assert sum(g == bool(y) for g, (_, y) in zip(got, test, strict=True)) >= 195
    docs = documents(spark, AWKWARD)
    rows = tox.score(docs, model, F.lit(False)).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    texts = sample(300, 3)
    docs = documents(spark, [(i, t) for i, (t, _) in enumerate(texts)])
    schema = "doc_id long, quality int, toxic int, text string"
    labels = [(i, 1, y, "x") for i, (_, y) in enumerate(texts)]
    first = tox.toxicity_scores(docs, spark.createDataFrame(labels, schema)).collect()
    held = {r.doc_id for r in first if r.held_out}
    assert 20 < len(held) < 120
    turned = [(i, q, 1 - y if i in held else y, t) for i, q, y, t in labels]
    second = tox.toxicity_scores(docs, spark.createDataFrame(turned, schema)).collect()
    assert sorted(first) == sorted(second)
    none = tox.toxicity_scores(docs, spark.createDataFrame([], schema)).collect()
    assert len(none) == len(texts)
    assert tox.toxicity_scores(docs.limit(0), spark.createDataFrame([], schema)).count() == 0
