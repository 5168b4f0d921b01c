"""A linear-chain conditional random field in numpy, over batches of sequences.

Sequences lie one after another in flat arrays, with their lengths. Every step works on
all sequences of the batch that are that long, so nothing is padded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Packed:
    """Where each step of each sequence lies; sequences in descending order of length."""

    starts: np.ndarray
    active: list[int]  # how many sequences have a step t
    rows: np.ndarray  # position in the batch of the sequence at each place of the order

    @staticmethod
    def of(lengths: np.ndarray) -> Packed:
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max()) if len(lengths) else 0
        ends = np.bincount(lengths, minlength=longest + 1)
        active = (len(lengths) - np.cumsum(ends)).tolist()[:longest]
        return Packed(first[order], active, order)


@dataclass
class Chain:
    """Weights of features by label, and scores of labels that follow each other."""

    weights: np.ndarray  # features x labels
    steps: np.ndarray  # labels x labels

    def marginals(self, emit: np.ndarray, lengths: np.ndarray, edges: bool = False):
        """Forward-backward: P(label) of every item; with ``edges`` also the expected steps
        and the sum of the log partition functions."""
        p = Packed.of(lengths)
        forward = np.empty_like(emit)
        for t, k in enumerate(p.active):
            at = p.starts[:k] + t
            if t:
                before = forward[at - 1][:, :, None] + self.steps[None]
                forward[at] = _logsum(before, 1) + emit[at]
            else:
                forward[at] = emit[at]
        backward = np.zeros_like(emit)
        for t in range(len(p.active) - 1, 0, -1):
            at = p.starts[: p.active[t]] + t
            after = (emit[at] + backward[at])[:, None, :] + self.steps[None]
            backward[at - 1] = _logsum(after, 2)
        both = forward + backward
        total = _logsum(both, 1)
        out = np.exp(both - total[:, None])
        if not edges:
            return out
        expected = np.zeros_like(self.steps)
        for t in range(1, len(p.active)):
            at = p.starts[: p.active[t]] + t
            joint = forward[at - 1][:, :, None] + (emit[at] + backward[at])[:, None, :]
            expected += np.exp(joint + self.steps - total[at][:, None, None]).sum(axis=0)
        return out, expected, float(total[p.starts[lengths[p.rows] > 0]].sum())

    def viterbi(self, emit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best label sequence; of equal ones the lower label number wins."""
        p = Packed.of(lengths)
        best = np.empty_like(emit)
        back = np.zeros(emit.shape, np.int16)
        for t, k in enumerate(p.active):
            at = p.starts[:k] + t
            if t:
                before = best[at - 1][:, :, None] + self.steps[None]
                back[at] = before.argmax(axis=1)
                best[at] = before.max(axis=1) + emit[at]
            else:
                best[at] = emit[at]
        out = np.zeros(len(emit), np.int64)
        for t in range(len(p.active) - 1, -1, -1):
            k = p.active[t]
            at = p.starts[:k] + t
            longer = p.active[t + 1] if t + 1 < len(p.active) else 0
            ends = at[longer:]
            out[ends] = best[ends].argmax(axis=1)
            if longer:
                out[at[:longer]] = back[at[:longer] + 1, out[at[:longer] + 1]]
        return out


def fit(
    features: np.ndarray,
    labels: np.ndarray,
    lengths: np.ndarray,
    n_labels: int,
    rounds: int = 100,
    rate: float = 0.2,
    decay: float = 1e-3,
    start: Chain | None = None,
) -> Chain:
    """Maximum likelihood with an L2 penalty by Adam over the whole sample."""
    n = features.shape[1]
    chain = start or Chain(np.zeros((n, n_labels)), np.zeros((n_labels, n_labels)))
    one_hot = np.eye(n_labels)[labels]
    inner = np.ones(len(labels), bool)
    inner[np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)[lengths > 0]] = False
    seen = np.zeros((n_labels, n_labels))
    at = np.flatnonzero(inner)
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    params = np.concatenate([chain.weights.ravel(), chain.steps.ravel()])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for i in range(1, rounds + 1):
        own = Chain(params[: n * n_labels].reshape(n, n_labels), params[n * n_labels :].reshape(
            n_labels, n_labels
        ))
        p, edges, _ = own.marginals(features @ own.weights, lengths, edges=True)
        slope = np.concatenate([(features.T @ (p - one_hot)).ravel(), (edges - seen).ravel()])
        slope = slope / max(len(labels), 1) + decay * params
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        params = params - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return Chain(
        params[: n * n_labels].reshape(n, n_labels),
        params[n * n_labels :].reshape(n_labels, n_labels),
    )
