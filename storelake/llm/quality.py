"""Document quality: a linear-chain CRF labels lines as good or bad.

Line features with those of both neighbours feed the chain. Marginals of "good" from
forward-backward, weighted by line length, give a document's share of good text, and a
logistic curve fitted on the training documents turns the share into a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from storelake.llm import crf
from storelake.llm.common import fold, labelled_sample, text_of

BAD, GOOD = 0, 1
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_PLAIN = _LETTERS + _DIGITS + b" \t\r\x0b\x0c"
_PROSE = b".,;:'\"()-?"
_OWN = 17
N_FEATURES = 1 + 3 * _OWN


def _line(line: bytes, repeated: bool) -> tuple[float, ...]:
    n = len(line)
    words = line.split()
    if not words:
        return (1.0,) + (0.0,) * (_OWN - 1)
    k = len(words)
    other = line.translate(None, _PLAIN)
    odd = len(other.translate(None, _PROSE)) / n
    letters = n - len(line.translate(None, _LETTERS))
    upper = n - len(line.translate(None, _UPPER))
    digits = n - len(line.translate(None, _DIGITS))
    distinct = len(set(words))
    same_next = sum(map(eq, words, words[1:]))
    short = sum(1 for w in words if len(w) <= 3)
    return (
        0.0,
        min(1.0, 4 * odd),
        min(1.0, 10 * line.count(b"|") / n),
        upper / max(letters, 1),
        min(1.0, 4 * digits / n),
        1 - distinct / k,
        float(distinct / k < 0.3 and k >= 10),
        same_next / k,
        short / k,
        min(1.0, letters / n),
        min(3.0, len(b"".join(words)) / k / 8),
        math.log1p(n) / 10,
        float(words[-1][-1:] in (b".", b"!", b"?", b":")),
        float(line[:1] in (b" ", b"\t") or line[:1].islower()),
        float(k < 4),
        float(repeated),
        min(1.0, 20 * line.count(b"!") / n),
    )


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows of all lines, lines per document, and bytes of each line (1 at least)."""
    own, counts, weights = [], [], []
    for text in texts:
        lines = text.split(b"\n")
        seen: set[bytes] = set()
        for line in lines:
            own.append(_line(line, line in seen))
            seen.add(line)
        counts.append(len(lines))
        weights.extend(max(1, len(line)) for line in lines)
    mine = np.array(own, np.float32).reshape(-1, _OWN)
    lengths = np.array(counts, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    before, after = np.zeros_like(mine), np.zeros_like(mine)
    before[1:], after[:-1] = mine[:-1], mine[1:]
    before[starts] = 0  # the neighbours of another document do not count
    after[starts + lengths - 1] = 0
    bias = np.ones((len(mine), 1), np.float32)
    return np.hstack([bias, mine, before, after]), lengths, np.array(weights, np.float64)


@dataclass
class Model:
    chain: crf.Chain
    slope: float
    shift: float

    def shares(self, texts: list[bytes]) -> np.ndarray:
        """The length-weighted mean marginal of "good" of each text."""
        x, lengths, weights = features(texts)
        good = self.chain.marginals(x @ self.chain.weights, lengths)[:, GOOD]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        return np.add.reduceat(good * weights, starts) / np.add.reduceat(weights, starts)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        z = np.clip(self.slope * self.shares(texts) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted one-variable logistic curve, lightly penalised."""
    design = np.stack([x, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (y - p)) - 1e-2 * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.linalg.solve(hess, grad)
    return float(beta[0]), float(beta[1])


def fit(sample: list[tuple[str, int]], relabel: int = 2) -> Model:
    """Fits on (text, label) rows; ``relabel`` rounds find the good lines of bad documents.

    Labels are of documents. Lines start with the label of theirs, and a first fit takes
    each line alone, without neighbours. Then each round takes the fitted marginals: in a
    bad document only lines below one half stay bad, and its worst line always does.
    Without both classes every document gets the score of the one there is.
    """
    y = np.array([label for _, label in sample], np.int64)
    if len(set(y.tolist())) < 2:
        chain = crf.Chain(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))
        return Model(chain, 0.0, 4.0 if not len(y) or y[0] == 1 else -4.0)
    texts = [t.encode() for t, _ in sample]
    x, lengths, weights = features(texts)
    x = x.astype(np.float64)
    doc = np.repeat(np.arange(len(y)), lengths)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    lines = y[doc].copy()
    alone = x.copy()
    alone[:, 1 + _OWN :] = 0
    each = np.ones(len(x), np.int64)
    chain = crf.fit(alone, lines, each, 2)
    good = chain.marginals(alone @ chain.weights, each)[:, GOOD]
    for i in range(relabel):
        if i:
            good = chain.marginals(x @ chain.weights, lengths)[:, GOOD]
        worst = np.minimum.reduceat(good, starts)[doc]
        lines = np.where((y[doc] == 1) | ((good >= 0.5) & (good > worst)), GOOD, BAD)
        chain = crf.fit(x, lines, lengths, 2, rounds=60, start=chain)
    model = Model(chain, 0.0, 0.0)
    # The two classes fill half of the sample each, so either counts by its own number.
    slope, shift = _logistic(model.shares(texts), y.astype(np.float64), np.ones(len(y)))
    return Model(chain, slope, shift)


def train(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: Column,
    max_docs: int = 2000,
    max_chars: int = 20_000,
) -> Model:
    return fit(labelled_sample(docs, labels, "quality", train_rows, max_docs, max_chars))


def score(docs: DataFrame, model: Model, held_out: Column, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``, from its text alone.

    Whole texts are read, in Arrow batches, without a shuffle. Null and empty texts are
    one empty line and get the score of that. Rows that repeat an id are scored each.
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


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The scores with rows of id fold 2 of 4 held out from training."""
    held_out = fold("doc_id", 4) == 2
    return score(docs, train(docs, labels, ~held_out), held_out)


def keep_good(docs: DataFrame, model: Model, cut: float = 0.7) -> DataFrame:
    """``docs`` without the rows that the model scores below ``cut``; columns unchanged."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = [(t or "").encode() for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(model.scores(texts) >= cut, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
