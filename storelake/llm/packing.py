"""Best-fit packing of token sequences by length patterns and non-negative least squares.

Packing looks at lengths only, so the plan is made from the histogram of piece lengths,
which has at most ``capacity`` bins whatever the number of documents:

1. Enumerate patterns of two to four lengths that fill a sequence exactly.
2. Fit how often each is used to the histogram by non-negative least squares.
3. Round down, as far as the histogram goes.
4. Pack what is left over by best fit, longest first, for all pieces of one length at once.

Each piece finds its place by its rank among the pieces of its length. Ranks come from
counts per task and length, so equal lengths, however many, never meet in one task.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.common import few_tasks, text_of, written
from storelake.llm.subwords import default_vocabulary, in_blocks, loaded

CAPACITY, END_ID = 4096, 1
#: How much of the fitted repeats a plan may follow, most first.
SHARES = (1.0, 0.75, 0.5, 0.25, 0.1)


@dataclass
class Plan:
    """Where the pieces of each length go: rows of
    (first rank, first sequence, pieces per sequence, first offset)."""

    capacity: int
    slots: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    used: dict[int, int] = field(default_factory=dict)
    sequences: int = 0

    def put(self, length: int, sequence: int, each: int, offset: int, pieces: int) -> None:
        rank = self.used.get(length, 0)
        self.slots.setdefault(length, []).append((rank, sequence, each, offset))
        self.used[length] = rank + pieces

    def arrays(self) -> dict[int, np.ndarray]:
        return {n: np.array(rows, np.int64) for n, rows in self.slots.items()}


def patterns(hist: np.ndarray, capacity: int, partners: int = 12) -> np.ndarray:
    """Rows of four lengths (0: none) that add up to ``capacity``, all in the histogram.

    All pairs; and for triples and quadruples each length goes with the ``partners``
    most frequent lengths that leave a present one.
    """
    present = np.flatnonzero(hist[: capacity + 1])
    present = present[present > 0]
    a = present[present <= capacity - present]
    a = a[hist[capacity - a] > 0]
    found = [np.stack([a, capacity - a, 0 * a, 0 * a], 1)]
    common = present[np.argsort(-hist[present], kind="stable")][:partners]
    for extra in [(c,) for c in common] + [(c, d) for c in common for d in common if c <= d]:
        rest = capacity - sum(extra)
        b = present[present <= rest // 2]
        b = b[hist[rest - b] > 0] if rest > 0 else b[:0]
        ones = np.ones_like(b)
        more = [ones * extra[0], ones * (extra[1] if len(extra) > 1 else 0)]
        found.append(np.stack([b, rest - b, *more], 1))
    rows = -np.sort(-np.concatenate(found), axis=1)
    return np.unique(rows, axis=0) if len(rows) else rows


def least_squares(rows: np.ndarray, hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' total histogram nearest to ``hist``.

    Accelerated projected gradient. A pattern holds four lengths at most, so gradients
    are gathers and bin counts; lengths without pieces carry no weight.
    """
    x = np.zeros(len(rows))
    if not len(x):
        return x
    flat, n = rows.ravel(), len(hist)
    load = np.bincount(flat, minlength=n).astype(float)
    load[0] = 0
    bound = 4 * max(1.0, load.max())  # of the largest eigenvalue, by row and column sums
    want = hist.astype(float).copy()
    want[0] = 0
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        have = np.bincount(flat, weights=np.repeat(y, rows.shape[1]), minlength=n)
        have[0] = 0
        gap = (want - have)[rows].sum(axis=1)
        new = np.maximum(0.0, y + gap / bound)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def make_plan(hist: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """A plan for ``hist[n]`` pieces of each length n from 1 to ``capacity``.

    Repeats that leave too many long pieces over would cost sequences: the fit is then
    followed in part. The plan with the fewest sequences counts, of these the one with
    the most repeats.
    """
    left = hist.astype(np.int64).copy()
    left[capacity] = 0
    rows = patterns(left, capacity)
    x = least_squares(rows, left)
    least = -(-int((hist * np.arange(len(hist))).sum()) // capacity)
    best = None
    for share in SHARES:
        plan = _follow(hist, capacity, rows, share * x)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences <= least:
            break
    return best


def _follow(hist: np.ndarray, capacity: int, rows: np.ndarray, x: np.ndarray) -> Plan:
    """Pattern i used x[i] times, rounded down; the rest by best fit."""
    plan = Plan(capacity)
    left = hist.astype(np.int64).copy()
    if left[capacity]:
        plan.put(capacity, 0, 1, 0, int(left[capacity]))
        plan.sequences, left[capacity] = int(left[capacity]), 0
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        lengths, each = np.unique(rows[i][rows[i] > 0], return_counts=True)
        times = int(min(np.floor(x[i] + 1e-9), (left[lengths] // each).min()))
        if times <= 0:
            continue
        offset = 0
        for n, k in zip(lengths.tolist(), each.tolist(), strict=True):
            plan.put(n, plan.sequences, k, offset, times * k)
            offset += n * k
        left[lengths] -= times * each
        plan.sequences += times
    # Best fit of the rest. room[r]: runs of sequences (first, how many) with r places left.
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    open_at = np.zeros(capacity + 1, bool)
    for n in range(capacity, 0, -1):
        count = int(left[n])
        while count:
            fits = np.flatnonzero(open_at[n:])
            if len(fits):
                r = n + int(fits[0])
                first, many = room[r].pop()
                open_at[r] = bool(room[r])
            else:
                r, each = capacity, capacity // n
                first, many = plan.sequences, -(-count // each)
                plan.sequences += many
            each = min(r // n, count)
            full = min(many, count // each)
            plan.put(n, first, each, capacity - r, full * each)
            count -= full * each
            for rest, start, size in ((r - each * n, first, full), (r, first + full, many - full)):
                if size and rest:
                    room[rest].append((start, size))
                    open_at[rest] = True
    return plan


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every document with their rank in the task among equal lengths."""
    rows = docs.select("doc_id", text_of().cast("binary").alias("text"))

    def run(batches):
        coder, task, row = loaded(vocabulary), TaskContext.get().partitionId(), 0
        ranks: dict[int, int] = {}
        for b in batches:
            texts = b.column(1).to_pylist()
            at, out = [], []
            for start, stop in in_blocks(texts):
                ids, sizes = coder.encode(texts[start:stop])
                end = 0
                for i, size in enumerate(sizes.tolist(), start):
                    own = np.append(ids[end : end + size], np.int32(end_id)).astype("<u4")
                    end += size
                    for k in range(0, len(own), capacity):
                        part = own[k : k + capacity]
                        rank = ranks.get(len(part), 0)
                        ranks[len(part)] = rank + 1
                        crc = zlib.crc32(part.tobytes())
                        at.append(i)
                        out.append((row + i, k // capacity, k, len(part), crc, task, rank))
            row += len(texts)
            if not out:
                continue
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), *map(pa.array, columns, kinds)],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, row long, piece int, start long, length long, ids_crc32 long, "
        "task long, rank long",
    )


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, row_id.

    Every document is tokenized whole and ends with ``end_id``; null is the empty text,
    which is one piece of that id alone. Only documents longer than ``capacity`` are cut.
    ``row_id`` tells apart rows that repeat a doc_id. Other columns are ignored, an empty
    table gives no rows. Only the histogram of lengths comes to the driver, and the plan
    that goes out has no more rows than lengths and patterns.
    """
    path = vocabulary or default_vocabulary()
    cut = written(pieces(docs, path, capacity, end_id), "pack-pieces")
    held, total = cut.groupBy("task", "length").agg(F.count("*").alias("held")), cut.count()
    counts = written(few_tasks(held, total), "pack-counts")
    hist = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("held").alias("n")).collect():
        hist[r["length"]] = r["n"]
    slots = make_plan(hist, capacity).arrays()
    # One row per task and length: the pieces of this length in earlier tasks.
    earlier = (
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(
        "task", "length", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before")
    )
    ranked = cut.join(before, ["task", "length"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("rank") + F.col("before")).alias("rank"),
        F.shiftleft(F.col("task"), 33).bitwiseOR(F.col("row")).alias("row_id"),
    )

    def place(batches):
        for b in batches:
            length = b.column(3).to_numpy(zero_copy_only=False)
            rank = b.column(5).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for n in np.unique(length):
                mine, rows = length == n, slots[int(n)]
                r = rank[mine]
                first, base, each, at = rows[np.searchsorted(rows[:, 0], r, side="right") - 1].T
                sequence[mine] = base + (r - first) // each
                offset[mine] = at + (r - first) % each * n
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(5)], pa.array(sequence), pa.array(offset), b.column(6)],
                names=[
                    "doc_id", "piece", "start", "length", "ids_crc32",
                    "sequence_id", "offset", "row_id",
                ],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return few_tasks(ranked, total).mapInArrow(
        place,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long, row_id long",
    )
