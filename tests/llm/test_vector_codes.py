"""Product codes against plain k-means over all distances."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from storelake.llm import vector_codes as vc

SCHEMA = (
    "vec_id long, embedding array<float>, label int, id string, q string, state string, "
    "total string, code string, error string"
)
EXTRA = ("x",) * 6


def slow_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows: (vec_id, vector, label), kept ones; [(vec_id, code, error, label_error, digest)]."""
    whole = [(i, [math.floor(scale * float(np.float32(x))) for x in v], y) for i, v, y in rows]
    whole.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    size = len(whole[0][1]) // parts if whole else 0
    cut = [[q[p * size : (p + 1) * size] for p in range(parts)] for _, q, _ in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[0], []).append(c[p])
            new.append(
                [
                    [sum(col) // len(groups[e]) for col in zip(*groups[e], strict=True)]
                    if e in groups else old
                    for e, old in enumerate(books[p])
                ]
            )
        books = new
    final = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    digest = ",".join(str(x) for p in books for e in p for x in e)
    digest = hashlib.sha256(digest.encode()).hexdigest()
    errors = [sum(d for _, d in f) for f in final]
    sums = {}
    for (_, _, y), e in zip(whole, errors, strict=True):
        sums[y] = sums.get(y, 0) + e
    return [
        (i, "".join(f"{e:02x}" for e, _ in f), err, sums[y], digest)
        for (i, _, y), f, err in zip(whole, final, errors, strict=True)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(n, seed, length=24, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, length))
    return [
        (int(i), (centres[i % 5] + spread * rng.normal(size=length)).astype(np.float32).tolist(),
         [None, 0, 1][i % 3 if i % 7 else 1])
        for i in rng.permutation(n)
    ]


@pytest.mark.parametrize(("n", "spread"), [(400, 1.0), (300, 0.01), (16, 1.0), (7, 1.0), (1, 1.0)])
def test_matches_plain_k_means(spark, n, spread):
    rows = sample(n, n, spread=spread)
    df = vc.vector_codes(frame(spark, rows).repartition(3))
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert result(df) == sorted(slow_codes(rows), key=str)


def test_ties_repeats_and_bad_vectors(spark):
    rng = random.Random(1)
    grid = [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(16)], i % 2) for i in range(200)]
    rows = [*grid, *grid[:30], (3, [9.0] * 16, None), (None, [0.25] * 16, None)]
    bad = [(500, None, 1), (501, [None] * 16, 1), (502, [float("nan")] * 16, 1),
           (503, [float("inf")] + [0.0] * 15, 1), (-1, [0.0] * 15 + [None], 1)]
    assert result(vc.vector_codes(frame(spark, rows + bad))) == sorted(slow_codes(rows), key=str)
    assert vc.vector_codes(frame(spark, bad)).collect() == []
    assert vc.vector_codes(frame(spark, [])).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    ]
    with pytest.raises(ValueError, match="multiple"):
        vc.vector_codes(frame(spark, [*grid, (900, [1.0] * 8, 1)]))
    with pytest.raises(ValueError, match="too large"):
        vc.vector_codes(frame(spark, [(1, [1e30] * 16, 1)]))


def test_bounds_spare_most_comparisons_and_b_adapts(spark):
    rows = sample(2000, 9, length=64, spread=0.3)
    whole = vc.whole_vectors(frame(spark, rows), "vec_id", "embedding", "label", vc.SCALE)
    first = [r["q"] for r in whole.orderBy("id").limit(16).collect()]
    coder = vc.Coder(whole, first, vc.PARTS, 1 << 14)
    kept = []
    for _ in range(6):
        coder.assign()
        kept.append(coder.b)
    assert all(n.sum() == 2000 * vc.PARTS for n in coder.needed)
    assert coder.needed[-1][0] > 0.5 * coder.needed[-1].sum()
    assert coder.needed[-1][-1] < 0.3 * coder.needed[-1].sum()
    assert kept[0] == 4 and kept[-1] >= 2
    assert coder.sums[:, :, -1].sum() == 2000 * vc.PARTS  # sums kept by difference are whole


def test_settle_equals_all_distances():
    rng = np.random.default_rng(2)
    for b in (1, 3, 15):
        x = rng.integers(-5, 6, (500, 3))
        books = rng.integers(-5, 6, (16, 3))
        state = vc.Bounds.fresh(x, books, b)
        for _ in range(8):
            new = books + rng.integers(-1, 2, books.shape)
            state.shift(vc._moved(books[None], new[None])[0])
            books = new
            state.settle(x, books)
            assert (state.own == vc.squares(x, books).argmin(axis=1)).all()
            again = vc.unpacked(vc.packed([state, state]), 2, b)
            assert all((getattr(again[1], f) == getattr(state, f)).all() for f in ("own", "near", "lower"))
        assert vc.Bounds.cut(state, 1).near.shape == (500, 1)


def test_label_sums_by_salted_join(spark):
    coded = spark.createDataFrame(
        [(i, [None, 1, 2][i % 3], "00", i) for i in range(300)], "id long, label int, code string, error long"
    )
    few = result(vc.with_label_error(coded).select("id", "label_error"))
    assert result(vc.with_label_error(coded, few=0).select("id", "label_error")) == few
    assert dict(few)[0] == sum(range(0, 300, 3))
