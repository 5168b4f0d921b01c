from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from storelake.llm import packing
from storelake.llm.subwords import Subwords, default_vocabulary
from tests.llm.helpers import AWKWARD, documents


def check_plan(hist, capacity):
    plan = packing.make_plan(hist, capacity)
    spans = defaultdict(list)
    for n, rows in plan.slots.items():
        firsts = [r[0] for r in rows] + [int(hist[n])]
        assert firsts[0] == 0 and plan.used[n] == hist[n]
        for (rank, sequence, each, offset), stop in zip(rows, firsts[1:], strict=True):
            for i in range(stop - rank):
                spans[sequence + i // each].append((offset + i % each * n, n))
    assert sum(hist[1:]) == sum(map(len, spans.values()))
    for parts in spans.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at  # gapless from 0
            at += n
        assert at <= capacity
    assert set(spans) == set(range(plan.sequences))
    return plan.sequences


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_valid_and_tight(seed):
    rng = np.random.default_rng(seed)
    hist = np.zeros(65, np.int64)
    hist[1:] = rng.integers(0, [1, 3, 50, 400, 2, 2000][seed] + 1, 64)
    used = check_plan(hist, 64)
    # Pieces of more than half a sequence never share one.
    least = max(-(-int((hist * np.arange(65)).sum()) // 64), int(hist[33:].sum()))
    assert least <= used <= max(least + 2, 1.07 * least)


def test_least_squares_fits_an_exact_mixture():
    rows = np.array([[40, 24, 0, 0], [32, 32, 0, 0], [50, 14, 0, 0]])
    hist = np.zeros(65)
    for row, times in zip(rows, (30, 10, 7), strict=True):
        for n in row[row > 0]:
            hist[n] += times
    assert packing.least_squares(rows, hist) == pytest.approx([30, 10, 7], abs=0.05)


def test_pieces_and_places(spark):
    rows = AWKWARD + [(i, "some words, " * i) for i in range(20, 60)]
    got = packing.pack(documents(spark, rows).repartition(3)).collect()
    tok = Tokenizer.from_file(default_vocabulary())
    want = []
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((i, k // 4096, k, len(part), zlib.crc32(part.tobytes())))
    mine = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(mine, key=str) == sorted(want, key=str)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    assert len({(r.row_id, r.piece) for r in got}) == len(got)
    assert len({r.row_id for r in got}) == len(rows)


def test_empty_table(spark):
    assert packing.pack(documents(spark, AWKWARD).limit(0)).count() == 0


def test_subwords_equal_the_tokenizer():
    own = Subwords(default_vocabulary(), most_words=40)
    texts = [
        "it's WE'LL don't 'S", "İstanbul ΣΑΣ ῾", "x\x85y a\xa0b \x1c z", "<|endoftext|> a<|b", "½²3٣",
        "ﬁ 日本語 ß ªº é", "", " \n", "Déjà-vu déjà vu", "A" * 3000, *[t or "" for _, t in AWKWARD],
    ]
    for text in texts * 2:
        ids, sizes = own.encode([text.encode(), b"", text.encode()])
        want = own.whole.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and sizes.tolist() == [len(want), 0, len(want)]
