"""Weighted acyclic automata over word windows.

An automaton reads up to ``DEPTH`` words. The weight of an arc is how often the words up
to it occur, so one path of four words holds the counts of all its beginnings. Windows
come sorted, so each depth's arcs are where a window differs from the one before it; then,
from the deepest states up, states with the same arcs are merged into one.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

DEPTH = 4


def sorted_counts(windows: np.ndarray, weights: np.ndarray | None = None):
    """Distinct windows in order and their summed weights (1 each unless given)."""
    if not len(windows):
        return windows.reshape(-1, DEPTH), np.zeros(0, np.int64)
    base = np.int64(windows.max()) + 1
    wide = windows.astype(np.int64)
    left, right = wide[:, 0] * base + wide[:, 1], wide[:, 2] * base + wide[:, 3]
    if base < 55_000:  # four labels fit 63 bits
        order = np.argsort(left * base * base + right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.ones(len(order), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(new)
    if weights is None:
        sums = np.diff(np.append(at, len(order)))
    else:
        sums = np.add.reduceat(weights[order], at)
    return windows[order[at]], sums.astype(np.int64)


def levels(windows: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth, the rows at which a new beginning of that length starts, and its weight.

    The windows are distinct and sorted; label 0 stands for the end of a window.
    """
    out = []
    new = np.zeros(len(windows), bool)
    new[:1] = True
    for d in range(DEPTH):
        new[1:] |= windows[1:, d] != windows[:-1, d]
        at = np.flatnonzero(new)
        sums = np.add.reduceat(weights, at) if len(at) else np.zeros(0, np.int64)
        live = windows[at, d] != 0
        out.append((at[live], sums[live]))
    return out


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _merged(starts: np.ndarray, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States with equal arcs become one: (new number of each state, starts, arcs)."""
    n, sizes = len(starts) - 1, np.diff(starts)
    number, kept, known = np.empty(n, np.int64), [], 0
    for size in (0, 1):  # most states have one arc: equal ones by sorting
        own = np.flatnonzero(sizes == size)
        rows = arcs[starts[own]] if size else np.zeros((len(own), 1), np.int64)
        if len(own):
            order = np.lexsort(rows.T)
            new = np.ones(len(own), bool)
            new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
            number[own[order]] = known + np.cumsum(new) - 1
            kept.append(own[order[new]])
            known += int(new.sum())
    register: dict[bytes, int] = {}
    for s in np.flatnonzero(sizes > 1).tolist():
        key = arcs[starts[s] : starts[s + 1]].tobytes()
        found = register.setdefault(key, known)
        if found == known:
            kept.append(np.array([s]))
            known += 1
        number[s] = found
    kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
    new_starts = np.concatenate([[0], np.cumsum(sizes[kept])]).astype(np.int64)
    return number, new_starts, arcs[_spread(starts[kept], sizes[kept])]


@dataclass
class Automaton:
    """``words[i]`` is label i + 1; of each depth, where states' arcs start, and the arcs:
    (label, weight, state of the next depth)."""

    words: list[bytes]
    starts: list[np.ndarray]
    arcs: list[np.ndarray]

    @classmethod
    def build(cls, words: list[bytes], windows: np.ndarray, weights: np.ndarray) -> Automaton:
        """From sorted distinct windows of labels; only words that occur are kept."""
        used = np.unique(windows)
        used = used[used > 0]
        label = np.zeros(len(words) + 1, np.int64)
        label[used] = np.arange(1, len(used) + 1)
        by_depth = levels(windows, weights)
        starts, arcs = [], []
        parents = np.zeros(1, np.int64)
        for d, (at, sums) in enumerate(by_depth):
            of = np.searchsorted(parents, at, side="right") - 1
            starts.append(np.searchsorted(of, np.arange(len(parents) + 1)))
            arcs.append(np.stack([label[windows[at, d]], sums, np.arange(len(at))], axis=1))
            parents = at
        arcs[-1][:, 2] = 0
        for d in range(DEPTH - 1, 0, -1):
            number, starts[d], arcs[d] = _merged(starts[d], arcs[d])
            arcs[d - 1][:, 2] = number[arcs[d - 1][:, 2]]
        return cls([words[i - 1] for i in used.tolist()], starts, arcs)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """All windows with their weights, those that end before the last depth included."""
        found, weights = [], []
        state, seen, total = np.zeros(1, np.int64), np.zeros((1, DEPTH), np.int32), None
        for d in range(DEPTH):
            first, sizes = self.starts[d][state], np.diff(self.starts[d])[state]
            arc = _spread(first, sizes)
            of = np.repeat(np.arange(len(state)), sizes)
            label, weight, target = self.arcs[d][arc].T
            if total is not None:  # what does not go on ends here
                on = np.zeros(len(state), np.int64)
                np.add.at(on, of, weight)
                ends = total > on
                found.append(seen[ends])
                weights.append((total - on)[ends])
            seen, total, state = seen[of], weight, target
            seen[:, d] = label
        return np.concatenate([*found, seen]), np.concatenate([*weights, total])

    def compose(self, other: Automaton) -> np.ndarray:
        """For the full paths of this automaton, in order of ``windows()``-like labels, the
        weight that ``other`` gives the same words; both walk their arcs together.

        Returns rows (label 1..DEPTH of this automaton, weight in other). Paths that the
        other lacks are left out; every beginning of a path is a path.
        """
        label_there = {w: i for i, w in enumerate(other.words, 1)}
        there = np.array([0, *(label_there.get(w, -1) for w in self.words)], np.int64)
        mine, theirs = np.zeros(1, np.int64), np.zeros(1, np.int64)
        seen, out = np.zeros((1, DEPTH), np.int64), []
        for d in range(DEPTH):
            sizes = np.diff(self.starts[d])[mine]
            label, _, target = self.arcs[d][_spread(self.starts[d][mine], sizes)].T
            of = np.repeat(np.arange(len(mine)), sizes)
            # Arcs of the other automaton by (state, label): in order within a state.
            base = len(other.words) + 1
            state = np.repeat(np.arange(len(other.starts[d]) - 1), np.diff(other.starts[d]))
            known = state * base + other.arcs[d][:, 0]
            asked = theirs[of] * base + there[label]
            at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
            hit = np.flatnonzero((known[at] == asked) & (there[label] > 0)) if len(known) else at[:0]
            seen = seen[of[hit]]
            seen[:, d] = label[hit]
            out.append(np.column_stack([seen, other.arcs[d][at[hit], 1]]))
            mine, theirs = target[hit], other.arcs[d][at[hit], 2]
        return np.concatenate(out)

    def dumps(self) -> bytes:
        """Compact bytes: words in one string, numbers as narrow as they go, compressed."""
        arcs = [[_narrow(c) for c in a.T] for a in self.arcs]
        raw = pickle.dumps(
            (b" ".join(self.words), [_narrow(np.diff(s)) for s in self.starts], arcs), protocol=5
        )
        return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)

    @classmethod
    def loads(cls, raw: bytes) -> Automaton:
        size = int.from_bytes(raw[:8], "little")
        words, sizes, arcs = pickle.loads(pa.decompress(raw[8:], size, "zstd", asbytes=True))
        starts = [np.concatenate([[0], np.cumsum(s, dtype=np.int64)]) for s in sizes]
        return cls(
            words.split(b" ") if words else [],
            starts,
            [np.stack([c.astype(np.int64) for c in a], axis=1) for a in arcs],
        )


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else
                    np.uint32 if top < 1 << 32 else np.int64)


def union(automata: list[Automaton]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, windows and summed weights of all automata together."""
    words = sorted(set().union(*(a.words for a in automata)))
    label = {w: i for i, w in enumerate(words, 1)}
    parts, weights = [], []
    for a in automata:
        to = np.array([0, *map(label.__getitem__, a.words)], np.int32)
        found, sums = a.windows()
        parts.append(to[found])
        weights.append(sums)
    if not parts:
        return [], np.zeros((0, DEPTH), np.int32), np.zeros(0, np.int64)
    return words, *sorted_counts(np.concatenate(parts), np.concatenate(weights))
