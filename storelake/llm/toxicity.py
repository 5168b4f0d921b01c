"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, report, clause end, other. A
chain of small weighted transducers, composed into one machine, reads a clause:

* negation: an insult or threat within three words after "not" loses most of its weight;
* reported speech: what follows "said" or "called" in the clause loses most of it;
* target: a clause that names a target before an insult weighs more;
* threat: a threat counts only towards a target in the same clause;
* insult: passes insults and matched threats on as matches.

The words of the grammar are fixed seeds plus words and word beginnings learned from
labelled documents. Matched clauses, not words, make the features of a logistic curve.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame

from storelake.llm.common import fold, labelled_sample, text_of

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, MATCH = range(8)
SYMBOLS = 8

# Seed words of the grammar, by symbol.
SEEDS = {
    INSULT: "idiot moron stupid scum trash loser worthless pathetic disgusting clown dumb imbecile".split(),
    THREAT: "kill hurt destroy beat shoot stab murder burn crush".split(),
    TARGET: "you your yourself u he she they them him her these those people".split(),
    NEGATION: "not no never nobody none cannot isn aren wasn don doesn didn won".split(),
    REPORT: "said says say told called claimed claims wrote reported quoted according".split(),
}
SEED_WEIGHT = 2.0

_RUNS = regex.compile(r"\p{L}+")
_CLAUSE_END = (b".", b"!", b"?", b";", b":")
_BREAK = b"\x01"


@dataclass(frozen=True)
class Transducer:
    """A deterministic weighted transducer; ``arcs[state][symbol]`` is (next, out, weight)."""

    arcs: tuple[tuple[tuple[int, int, float], ...], ...]

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes; weights multiply."""
        number, queue, rows = {(0, 0): 0}, [(0, 0)], []
        for mine, theirs in queue:
            row = []
            for symbol in range(SYMBOLS):
                next_a, out, w = self.arcs[mine][symbol]
                next_b, final, v = other.arcs[theirs][out]
                pair = (next_a, next_b)
                if pair not in number:
                    number[pair] = len(number)
                    queue.append(pair)
                row.append((number[pair], final, w * v))
            rows.append(tuple(row))
        return Transducer(tuple(rows))


def _machine(states: int, rule) -> Transducer:
    return Transducer(
        tuple(tuple(rule(s, symbol) for symbol in range(SYMBOLS)) for s in range(states))
    )


def _negation(state: int, symbol: int) -> tuple[int, int, float]:
    if symbol == END:
        return 0, symbol, 1.0
    if symbol == NEGATION:
        return 3, symbol, 1.0
    weak = state > 0 and symbol in (INSULT, THREAT)
    return max(0, state - 1), symbol, 0.05 if weak else 1.0


def _reported(state: int, symbol: int) -> tuple[int, int, float]:
    if symbol in (END, REPORT):
        return int(symbol == REPORT), symbol, 1.0
    return state, symbol, 0.15 if state and symbol in (INSULT, THREAT) else 1.0


def _targeted(state: int, symbol: int) -> tuple[int, int, float]:
    if symbol in (END, TARGET):
        return int(symbol == TARGET), symbol, 1.0
    return state, symbol, 1.25 if state and symbol == INSULT else 1.0


def _threat(state: int, symbol: int) -> tuple[int, int, float]:
    # State 1: a threat waits for its target. State 2: the target came first.
    if symbol == END:
        return 0, symbol, 1.0
    if symbol == TARGET:
        return 2, MATCH if state == 1 else symbol, 1.0
    if symbol == THREAT:
        return (2, MATCH, 1.0) if state == 2 else (1, OTHER, 1.0)
    return state, symbol, 1.0


def _insult(state: int, symbol: int) -> tuple[int, int, float]:
    return 0, MATCH if symbol in (INSULT, MATCH) else OTHER, 1.0


GRAMMAR = (
    _machine(4, _negation)
    .then(_machine(2, _reported))
    .then(_machine(2, _targeted))
    .then(_machine(3, _threat))
    .then(_machine(1, _insult))
)


def cores(word: bytes) -> list[str]:
    """The runs of letters of a word, in lower case."""
    return [r.lower() for r in _RUNS.findall(word.decode())]


@dataclass
class Lexicon:
    """Symbol and weight of words; weights of learned words and word beginnings."""

    words: dict[str, float]
    starts: dict[str, float]
    kept: dict[bytes, tuple[int, float, bool]] = field(default_factory=dict)
    most_kept: int = 300_000

    def symbol(self, run: str) -> tuple[int, float]:
        weight = self.words.get(run, 0.0)
        for n in STARTS:
            if n <= len(run):
                weight = max(weight, self.starts.get(run[:n], 0.0))
        if weight:
            return INSULT, weight
        return _SEED_OF.get(run, (OTHER, 0.0))  # negations and targets carry no weight

    def read(self, words: list[bytes]) -> list[tuple[int, float, bool]]:
        """(symbol, weight, whether the clause ends here) of every word."""
        if len(self.kept) > self.most_kept:
            self.kept.clear()
        kept = self.kept
        for w in set(words).difference(kept):
            if w == _BREAK:
                kept[w] = (END, 0.0, False)
                continue
            found = [self.symbol(r) for r in cores(w)] or [(OTHER, 0.0)]
            best = max(found, key=lambda x: (x[1], x[0] != OTHER))
            kept[w] = (*best, w[-1:] in _CLAUSE_END)
        return [kept[w] for w in words]


STARTS = (3, 4, 5, 6, 7, 8)
_SEED_OF = {w: (s, SEED_WEIGHT if s in (INSULT, THREAT) else 0.0) for s in SEEDS for w in SEEDS[s]}


def clause_scores(text: bytes, lexicon: Lexicon) -> list[float]:
    """The weight of every clause with a match, in order.

    Clauses end at a line break or a word that ends in . ! ? ; or :.
    """
    words = text.replace(b"\n", b" \x01 ").split()
    read = lexicon.read(words)
    out: list[float] = []
    state, total, pending = 0, 0.0, 0.0
    if not any(symbol in (INSULT, THREAT) for symbol, _, _ in read):
        return out
    for symbol, weight, ends in read:
        state, result, factor = GRAMMAR.arcs[state][symbol]
        if symbol == THREAT:
            pending = weight * factor  # counts once its target comes
        if result == MATCH:
            total += pending if symbol == TARGET else weight * factor
        if ends and symbol != END:
            state, _, _ = GRAMMAR.arcs[state][END]
        if ends or symbol == END:
            if total > 0:
                out.append(total)
            total, pending = 0.0, 0.0
    if total > 0:
        out.append(total)
    return out


def features(text: bytes, lexicon: Lexicon) -> tuple[float, float, float, float]:
    scores = clause_scores(text, lexicon)
    if not scores:
        return 1.0, 0.0, 0.0, 0.0
    words = max(1, len(text.split()))
    return 1.0, max(scores), math.log1p(sum(scores)), math.log1p(1000 * sum(scores) / words)


def _gain(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Twice the log likelihood ratio of two document shares, signed."""
    p, q = toxic / n_toxic, clean / n_clean
    both = (toxic + clean) / (n_toxic + n_clean)

    def part(k: int, n: int, rate: float) -> float:
        return (k * math.log(rate) if k else 0.0) + ((n - k) * math.log(1 - rate) if n > k else 0.0)

    if both in (0.0, 1.0):
        return 0.0
    ratio = part(toxic, n_toxic, p) + part(clean, n_clean, q)
    ratio -= part(toxic, n_toxic, both) + part(clean, n_clean, both)
    return math.copysign(2 * max(0.0, ratio), p - q)


def learn_lexicon(sample: list[tuple[str, int]], least_gain: float = 25.0) -> Lexicon:
    """Words and word beginnings that toxic documents hold far more often than clean ones."""
    counts = {}
    totals = Counter(label for _, label in sample)
    if len(totals) == 2:
        word_in, start_in = (Counter(), Counter()), (Counter(), Counter())
        for text, label in sample:
            runs = {r.lower() for r in _RUNS.findall(text)}
            word_in[label].update(runs)
            start_in[label].update({r[:n] for r in runs for n in STARTS if n <= len(r)})
        most_by_one: dict[str, int] = {}
        for run, n in word_in[1].items():
            for start in {run[:k] for k in STARTS if k <= len(run)}:
                most_by_one[start] = max(most_by_one.get(start, 0), n)
        for kind, (clean, toxic) in (("words", word_in), ("starts", start_in)):
            kept = {}
            for key, n in toxic.items():
                if n < 5:
                    continue
                odds = math.log((n + 0.5) / (totals[1] + 1)) - math.log(
                    (clean[key] + 0.5) / (totals[0] + 1)
                )
                if kind == "starts" and 2 * most_by_one[key] > n:
                    continue  # one word explains it: a beginning must stand for several
                if odds > 1.5 and _gain(n, clean[key], totals[1], totals[0]) >= least_gain:
                    kept[key] = round(odds, 6)
            counts[kind] = kept
    return Lexicon(counts.get("words", {}), counts.get("starts", {}))


@dataclass
class Model:
    lexicon: Lexicon
    beta: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(-1, 4)
        return 1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30)))


def fit(sample: list[tuple[str, int]]) -> Model:
    """Learns the lexicon, then the curve over its clause features.

    With one class only, or none, the seed words and a fixed curve are used.
    """
    lexicon = learn_lexicon(sample)
    y = np.array([label for _, label in sample], float)
    beta = np.array([-3.0, 0.5, 1.0, 0.5])
    if 0 < y.sum() < len(y):
        x = np.array([features(t.encode(), lexicon) for t, _ in sample])
        beta = np.zeros(4)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            penalty = 0.05 * np.eye(4)
            grad = x.T @ (y - p) - penalty @ beta
            hess = (x * (p * (1 - p))[:, None]).T @ x + penalty
            beta = beta + np.linalg.solve(hess, grad)
    lexicon.kept.clear()
    return Model(lexicon, beta)


def train(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: Column,
    max_docs: int = 4000,
    max_chars: int = 20_000,
) -> Model:
    return fit(labelled_sample(docs, labels, "toxic", train_rows, max_docs, max_chars))


def score(docs: DataFrame, model: Model, held_out: Column, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, from its text alone.

    Whole texts are read, in Arrow batches, without a shuffle. Null and empty texts match
    nothing and get the score of that. Rows that repeat an id are scored each.
    """
    rows = docs.select(
        "doc_id", held_out.alias("held_out"), text_of().cast("binary").alias("text")
    )

    def run(batches):
        for b in batches:
            s = model.scores(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= cut).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The scores with rows of id fold 0 of 5 held out from training."""
    held_out = fold("doc_id", 5) == 0
    return score(docs, train(docs, labels, ~held_out), held_out)
