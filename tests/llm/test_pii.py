from __future__ import annotations

import hashlib
import random
import re

import pytest

from storelake.llm import pii
from tests.llm.helpers import AWKWARD, documents

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
            good = (
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if k == 1 else True,
                14 <= len(digits) <= 19 and luhn,
                10 <= len(digits) <= 15,
            )[k]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_patterns_equal_brute_force():
    rng = random.Random(4)
    alphabet = "ab.@+- ()0123456789é\n%"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == brute(text)
    for text in ("4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "+1 (212) 555-0134x", "٣.٣.٣.٣"):
        assert pii.base_spans(text) == brute(text)


def test_long_runs_stay_linear():
    assert pii.base_spans("1" * 200_000 + "." + "a" * 200_000 + "@" + "+ " * 50_000) == []


def test_the_chain_adds_what_patterns_miss():
    tagger = pii.fit()
    texts = [
        "Éçan 4012888888881881 4111111111111111 aique",  # one run of digits for the pattern
        "was +1 (826) 555-4081 190.137.223.204 du",
        "Ring (212) 555-0147 please",
        "Version 2.0 of 1999, pages 12-14, token = \"04dbebab91ab85687d33\"",
        "",
    ]
    bases = [pii.base_spans(t) for t in texts]
    added = pii.added_spans(texts, bases, tagger)
    found = [[t[a:b] for a, _, b in spans] for t, spans in zip(texts, added, strict=True)]
    assert found[0] == ["4012888888881881", "4111111111111111"]
    assert found[1] == ["+1 (826) 555-4081"] and found[2] == ["(212) 555-0147"]
    assert found[3:] == [[], []]


def test_trained_on_the_labelled_lines():
    tagger = pii.fit()
    for line in pii.LABELLED:
        words, labels = pii._parse(line)
        n = pii.np.array([len(words)])
        assert tagger.chain.viterbi(tagger.emissions(words, n), n).tolist() == labels, line


def test_table(spark):
    rows = AWKWARD + [(50, "mail a.b@c.de or 10.0.0.1, card 4111111111111111"), (50, None)]
    got = pii.find_personal_data(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    r = next(r for r in got if r.n_email)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 0)
    assert r.spans == "email:5:13,ip:17:25,card:32:48"
    assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    empty = next(r for r in got if r.doc_id == 1)
    assert empty.spans == "" and empty.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_personal_data(documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize(("digits", "good"), [("4111111111111111", True), ("4111111111111112", False)])
def test_luhn(digits, good):
    assert pii.luhn(digits) is good
