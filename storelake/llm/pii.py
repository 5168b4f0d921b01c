"""Personal data: fixed patterns, and a linear-chain CRF over word shapes beside them.

The CRF is trained from the labelled lines below and decoded by Viterbi in numpy batches.
It adds spans where the patterns find none, for instance two card numbers in a row or a
phone number without a country code. What it finds passes the same checks of digits.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storelake.llm import crf
from storelake.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")
#: Labels: 0 is none, then the first and the later words of each kind.
N_LABELS = 1 + 2 * len(KINDS)

# The patterns. No run of digits is entered in its middle, which changes no
# match but keeps long runs linear; addresses are found from their @ for the same reason.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SEEN = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    """The check of digits that a span of this kind must pass."""
    if kind == "ip":
        parts = text.split(".")
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all pattern matches that pass their check, in order."""
    if not _SEEN.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        for m in pattern.finditer(text):
            if valid(KINDS[k], m[0]):
                out.append((m.start(), k, m.end()))
    return sorted(out)


# The labelled table: spans are written {kind|text}.
LABELLED = """
Write to {email|anna.berg@mail.example.com} before noon.
Mail {email|j_smith+news@example.org}, please.
Her address is {email|mia99@post.example.net} or {email|mia.k@example.com}
contact: {email|sales@shop.example.com}; fax on request
send it to <{email|bo@lists.example.org}> today
The host {ip|192.168.10.24} did not answer.
Blocked {ip|10.0.0.7} and {ip|172.16.254.1} at noon.
from {ip|203.0.113.9}, port 8080
version 10.2.3 was released in 2019
Section 4.2.1 of report 17 lists 250 cases.
Pay with {card|4111 1111 1111 1111} until Friday.
His card {card|5500-0000-0000-0004} has expired.
{card|4111111111111111} and {card|5500000000000004} were stolen
cards {card|4012888888881881} {card|4111111111111111} on file
the number {card|340000000000009} was charged twice
paid {card|4012888888881881} yesterday
they listed {card|6011000000000004} {card|4111111111111111} there
Call {phone|+1 (212) 555-0134} after six.
Phone: {phone|+44 20 7946 0958}
Ring {phone|(212) 555-0147} or {phone|+49 30 901820}
my number is {phone|212-555-0161}, ask for Bo
tel {phone|030 9018 2000} at work
fax {phone|(030) 901-8200} or mail
call me at {phone|415-555-0199}.
dial {phone|+33 1 70 18 99 00} now
was {phone|+1 (017) 555-7713} {ip|137.222.200.4} and so on
we met {phone|+1 (826) 555-4081} {email|x.1@mail1.example.com} there
In 1998 there were 12 of them, in 2004 only 7.
Released under version 3.0 of the licence, 2004.
the token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" was revoked
Order 20481 of 12 May 2020 cost 1,250.50 in all.
Licensed under CC BY-NC 4.0.
Pages 120-135 and 210-219 deal with 3 such cases.
room 12 b, 2nd floor, 10115 town
score 3-2 in minute 90, half time 1-1
a 16 digit serial 12345678 was found
@home and @work are tags, 50% of 200 is 100
meet at 10:30 or 11:45 on 2021-03-04
""".strip().split("\n")

_OPEN, _CLOSE = "\"'([{<*#", ".,;:!?\"')]}>*#$%&|"


def shape(word: str) -> str:
    """The word with runs of letters as a, of digits as a letter for their length."""
    core = word.strip("\"'<>*#$%&|,;:!?").rstrip(".")

    def one(m: re.Match) -> str:
        n = len(m[0])
        if not m[0][0].isdigit():
            return "a"
        return "n" if n <= 3 else "q" if n == 4 else "m" if n <= 9 else "k" if n <= 13 else (
            "c" if n <= 19 else "z"
        )

    return re.sub(r"[0-9]+|[^\W\d_]+", one, core)[:24]


def _own(word: str) -> list[str]:
    s = shape(word)
    digits = sum(c in "0123456789" for c in word)
    out = ["s=" + s, f"d={min(digits, 20)}", f"at={'@' in word}", f"plus={word[:1] == '+'}"]
    if digits == 0 and "@" not in word:
        out += ["plain", "w=" + word.lower().strip(_OPEN + _CLOSE)]
    if word[:1] == "(":
        out.append("open")
    if word[-1:] in ".,;:!?":
        out.append("stop")
    return out


def _near(word: str) -> list[str]:
    digits = sum(c in "0123456789" for c in word)
    out = [f"d={min(digits, 20)}", "s=" + shape(word)]
    return out if digits else ["plain", "w=" + word.lower().strip(_OPEN + _CLOSE)]


def _parse(line: str) -> tuple[list[str], list[int]]:
    words: list[str] = []
    labels: list[int] = []
    for m in re.finditer(r"\{(\w+)\|([^}]*)\}(\S*)|\S+?(?=\{|\s|$)", line):
        if m[1] is None:
            words.append(m[0])
            labels.append(0)
            continue
        inside = m[2].split()
        first = 1 + 2 * KINDS.index(m[1])
        words += inside
        labels += [first] + [first + 1] * (len(inside) - 1)
        words[-1] += m[3]
    return words, labels


@dataclass
class Tagger:
    """The trained chain; weights by feature for a word, the one before and the one after."""

    chain: crf.Chain
    number: dict[str, int]
    most_kept: int = 200_000

    def __post_init__(self):
        self.kept: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def _vectors(self, word: str) -> np.ndarray:
        out = np.zeros((3, N_LABELS))
        for role, names in enumerate((_own(word), _near(word), _near(word))):
            for name in names:
                at = self.number.get(f"{role}{name}")
                if at is not None:
                    out[role] += self.chain.weights[at]
        return out

    def emissions(self, words: list[str], lengths: np.ndarray) -> np.ndarray:
        if len(self.kept) > self.most_kept:
            self.kept.clear()
            self.rows.clear()
        for w in set(words).difference(self.kept):
            self.kept[w] = len(self.rows)
            self.rows.append(self._vectors(w))
        at = [self.kept[w] for w in words]
        used, local = np.unique(at, return_inverse=True)
        vectors = np.stack([self.rows[i] for i in used])[local]
        out = vectors[:, 0].copy()
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        inner = np.ones(len(words), bool)
        inner[starts] = False
        later = np.flatnonzero(inner)
        out[later] += vectors[later - 1, 1]  # the word before
        out[later - 1] += vectors[later, 2]  # the word after
        return out + self.chain.weights[self.number["bias"]]


def fit(lines: list[str] = LABELLED) -> Tagger:
    parsed = [_parse(line) for line in lines]
    number: dict[str, int] = {"bias": 0}
    active: list[list[int]] = []
    for words, _ in parsed:
        for i, w in enumerate(words):
            names = ["0" + n for n in _own(w)]
            names += ["1" + n for n in _near(words[i - 1])] if i else []
            names += ["2" + n for n in _near(words[i + 1])] if i + 1 < len(words) else []
            active.append([0, *(number.setdefault(n, len(number)) for n in names)])
    x = np.zeros((len(active), len(number)))
    for row, names in enumerate(active):
        x[row, names] = 1
    y = np.array([label for _, labels in parsed for label in labels])
    lengths = np.array([len(words) for words, _ in parsed])
    return Tagger(crf.fit(x, y, lengths, N_LABELS, rounds=150, rate=0.1), number)


def added_spans(
    texts: list[str], bases: list[list[tuple[int, int, int]]], tagger: Tagger
) -> list[list[tuple[int, int, int]]]:
    """For each text the CRF's spans that pass their check and overlap no base span.

    A line without a digit and without @ can hold no span of these kinds and is not decoded.
    """
    words, lengths, places = [], [], []
    for i, text in enumerate(texts):
        if not _SEEN.search(text):
            continue
        start = 0
        for line in text.split("\n"):
            if _SEEN.search(line):
                found = [(m.start() + start, m[0]) for m in _WORD.finditer(line)]
                words += [w for _, w in found]
                places += [(i, a) for a, _ in found]
                lengths.append(len(found))
            start += len(line) + 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not words:
        return out
    sizes = np.array(lengths, np.int64)
    labels = tagger.chain.viterbi(tagger.emissions(words, sizes), sizes)
    ends = set(np.cumsum(sizes).tolist())
    tagged = np.flatnonzero(labels)
    k = 0
    while k < len(tagged):
        first = last = int(tagged[k])
        kind = (int(labels[first]) - 1) // 2
        k += 1
        while (
            k < len(tagged)
            and tagged[k] == last + 1
            and labels[tagged[k]] == 2 * kind + 2
            and last + 1 not in ends
        ):
            last = int(tagged[k])
            k += 1
        i, a = places[first]
        b = places[last][1] + len(words[last])
        text = texts[i]
        skip = _OPEN if kind != 3 else _OPEN.replace("(", "")
        while a < b and text[a] in skip:
            a += 1
        while b > a and text[b - 1] in _CLOSE:
            b -= 1
        clash = any(s < b and a < e for s, _, e in bases[i])
        if not clash and _looks_like(KINDS[kind], text[a:b]) and valid(KINDS[kind], text[a:b]):
            out[i].append((a, kind, b))
    return out


def _looks_like(kind: str, text: str) -> bool:
    """Whether the characters of a span are those of its kind."""
    if kind == "email":
        return bool(re.fullmatch(r"[^@\s]+@[^@\s]+", text))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text))
    return bool(re.fullmatch(r"[+(]?[0-9][\x20().0-9-]*[0-9]", text))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find_personal_data(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest are of the pattern matches; ``spans`` holds these and the
    n_added spans of the CRF. Positions are code points. Whole texts are read, in Arrow
    batches, without a shuffle; null is the empty text. Other columns are ignored.
    """
    model = tagger or fit()
    rows = docs.select("doc_id", text_of().alias("text"))

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            bases = [base_spans(t) for t in texts]
            added = added_spans(texts, bases, model)
            counts = [[sum(s[1] == k for s in base) for base in bases] for k in range(len(KINDS))]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base in bases]
            spans = [joined(x + y) for x, y in zip(bases, added, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                    pa.array([len(y) for y in added], pa.int64()),
                ],
                names=[
                    "doc_id", "n_email", "n_ip", "n_card", "n_phone",
                    "base_sha256", "spans", "n_added",
                ],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, n_added long",
    )
