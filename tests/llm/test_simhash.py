"""SimHash components against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from storelake.llm import simhash
from storelake.llm.components import connected_components

SCHEMA = "doc_id long, text string, key string, fp long, component_id string"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """prints: [(id, fp)]; the smallest id reachable from each row, by repeated sweeps."""
    label = [i for i, _ in prints]
    changed = True
    while changed:
        changed = False
        for x, (_, a) in enumerate(prints):
            for y, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= 2 and label[y] < label[x]:
                    label[x], changed = label[y], True
    return label


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{i}É" for i in range(60)]
    out = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 300]))]
        for _ in range(3):
            copy = list(base)
            if rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = "Changed"
            out.append(" ".join(copy))
    return [*out, "", None, "  \t", "A b", "a B", "a b", "x\x85y z", "x y z" * 20_000]


def test_components_match_brute_force(spark, texts):
    ids = list(range(7, 7 + len(texts)))
    df = spark.createDataFrame(
        [(i, t, "k", 1, "c") for i, t in zip(ids, texts, strict=True)], SCHEMA
    )
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_components(df).collect()}
    prints = [(i, slow_fingerprint(t or "")) for i, t in zip(ids, texts, strict=True)]
    want = dict(zip(ids, slow_components(prints), strict=True))
    assert {i: c for i, (_, c) in got.items()} == want
    assert {i: f for i, (f, _) in got.items()} == {i: f"{fp:016x}" for i, fp in prints}
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("most_in_block", [512, 3])
def test_links_join_what_brute_force_joins(spark, most_in_block):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, 2**64 - 1, *base}
    for b in base:
        for _ in range(25):
            b ^= 1 << rng.randrange(64)
            fps.add(b ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = connected_components(simhash.links(nodes, most_in_block)).collect()
    root = {r.node: r.root for r in found}
    groups = {}
    for f in signed:
        groups.setdefault(root.get(f, f), set()).add(f)
    want = {}
    for f, lab in zip(signed, slow_components(list(zip(fps, fps, strict=True))), strict=True):
        want.setdefault(lab, set()).add(f)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in want.values()}


def test_near_pairs_are_complete():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**64, 5, dtype=np.uint64)
    fp = np.unique(np.concatenate([fp, fp ^ np.uint64(1), fp ^ np.uint64(6), fp ^ np.uint64(7)]))
    coords = np.bitwise_count(fp[:, None] ^ simhash.REFERENCES[None, :]).astype(np.uint8)
    group = np.arange(len(fp)) % 2
    left, right = simhash.near_pairs(group, fp, coords)
    got = {frozenset(p) for p in zip(left.tolist(), right.tolist(), strict=True)}
    want = {
        frozenset((i, j))
        for i in range(len(fp))
        for j in range(i)
        if group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= 2
    }
    assert got == want


def test_long_chains_and_nulls(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 500), (None, 3)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(201)}


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_components(empty).count() == 0
    rows = [(None, "same words here", "k", 1, "c"), (9, "same words here", "k", 1, "c")] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.component_id for r in simhash.near_components(df).collect()} == {9}
    assert [r.doc_id for r in simhash.drop_near_copies(df).collect()] == [9, 9]


def test_pairs_are_held_for_a_bounded_number_of_fingerprints():
    sizes = np.array([300, 300, 300, 900, 2])
    assert simhash.block_runs(sizes, 600) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert simhash.block_runs(sizes[:0], 600) == []
