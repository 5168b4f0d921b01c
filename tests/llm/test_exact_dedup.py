from __future__ import annotations

import hashlib

from storelake.llm import exact_dedup
from tests.llm.helpers import AWKWARD, documents


def brute(rows):
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    out = []
    for t, ids in by_text.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def test_groups_match_brute_force(spark):
    rows = AWKWARD + [(i, f"copy {i % 3}") for i in range(20, 60)]
    got = exact_dedup.exact_dedup(documents(spark, rows), capacity=4).collect()
    plain = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str)
    assert plain == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t in rows})  # one row of each group
    assert all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_stay_keep_all_columns(spark):
    df = documents(spark, AWKWARD)
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [r for r in AWKWARD if r[0] not in (1, 2, 4, 5)] + [(2, ""), (5, "one")]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    empty = documents(spark, AWKWARD).limit(0)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    cells = [(c,) for c in [0] * 3 + [1] * 3 + [1 << 15] * 2]
    got = exact_dedup.directory(spark.createDataFrame(cells, "cell long"), 4).collect()
    depth = {r.cell: r.depth for r in got}
    assert depth == {0: exact_dedup.MAX_DEPTH, 1: exact_dedup.MAX_DEPTH, 1 << 15: 1}
    one = exact_dedup.directory(spark.createDataFrame(cells, "cell long"), 100).collect()
    assert {(r.depth, r.bucket) for r in one} == {(0, 0)}
