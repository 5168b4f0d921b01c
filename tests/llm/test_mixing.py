from __future__ import annotations

import re
from collections import Counter

import pytest

from storelake.llm import mixing
from tests.llm.helpers import AWKWARD, documents


def fill(sizes, weights=(5, 2, 1), most=3):
    """Water-filling by the book: clamp what is above, share the rest anew, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in target]
        left = total - sum(target.values())
        over = [
            s for s in free
            if weight[s] * left / sum(weight[x] for x in free) > most * sizes[s] + 1e-9
        ]
        if not over:
            return target | {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        target |= {s: float(most * sizes[s]) for s in over}


ROWS = [
    *[(r[0], r[1], s) for r, s in zip(AWKWARD, ["b", None, "b", "é", "a"] * 3, strict=False)],
    *[(100 + i, f"w{i} " * (i % 7 + 1), "abcdef"[i % 6]) for i in range(300)],
    (900, "lonely words here", "tiny"), (901, "", "hollow"),
]


def test_targets_and_amounts(spark):
    docs = documents(spark, ROWS)
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in ROWS]
    assert sorted(r.size for r in got) == sorted(words)
    sizes = Counter()
    for (_, _, s), n in zip(ROWS, words, strict=True):
        sizes[s] += n
    want = fill(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    # Only documents of one hash cell are rounded.
    assert all(abs(taken[s] - want[s]) <= 5 for s in want)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_rows_of_the_mix_are_whole_documents(spark):
    rows = [(i, f"a{i}\tb\n\nc  d e", "xy"[i % 2]) for i in range(400)] + [(999, None, "x")]
    docs = documents(spark, rows)
    out = mixing.mixed_rows(docs, weights=(4, 3))
    assert out.columns == docs.columns
    texts, held = {i: t for i, t, _ in rows}, Counter()
    for r in out.collect():
        assert r.text == texts[r.doc_id]
        held[r.doc_id] += 1
    assert held.pop(999) == 1
    amounts = mixing.mix(docs, weights=(4, 3)).where("size > 0").collect()
    sources, cut = {}, 0
    for r in amounts:
        assert held[r.doc_id] in (r.taken // 5, -(-r.taken // 5))
        cut += r.taken % 5 > 0
        target, words = sources.get(r.source, (r.target, 0))
        sources[r.source] = (target, words + 5 * held[r.doc_id])
    assert cut and all(abs(words - target) <= 5 * cut for target, words in sources.values())
    again = Counter(r.doc_id for r in mixing.mixed_rows(docs.repartition(3), weights=(4, 3)).collect())
    assert again == held + Counter([999])


def test_empty_table(spark):
    empty = documents(spark, ROWS).limit(0)
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_rows(empty).count() == 0
