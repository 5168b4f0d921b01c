"""Product codes of vectors: exact integer k-means with adaptive distance bounds.

Vectors become integers and are cut into parts; each part position has a codebook. For
every part a task keeps the assigned entry with an upper bound of its distance, the ``b``
closest other entries with ordered lower bounds, and one outer bound for all the rest.
When the entries have moved, the bounds move with them; a part whose upper bound is below
all lower bounds keeps its entry without a look at the vector. Otherwise the entries whose
bound it passes are compared, in whole numbers, and all entries where it passes the outer
bound. ``b`` shrinks to what the comparisons of the last pass needed.

The bounds are persisted with the vectors: each pass reads the last pass's table and
writes the next in the shared folder, and a pass is what a lost executor can cost. Only
sums and counts per entry meet, and only of parts that changed their entry.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from storelake.llm.common import forget, saved, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Share of the comparisons of a pass that must have got by with the next pass's ``b``.
ENOUGH = 0.99
#: Up to so many labels their error sums are broadcast; more are joined by salted label.
FEW_LABELS, SALTS = 100_000, 32


def state_type(parts: int, b: int) -> np.dtype:
    """What a row keeps between passes, of all its parts."""
    return np.dtype(
        [
            ("own", "u1", (parts,)),
            ("upper", "<f4", (parts,)),
            ("outer", "<f4", (parts,)),
            ("near", "u1", (parts, b)),
            ("lower", "<f4", (parts, b)),
        ]
    )


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whole-number squared distances of each row of ``x`` to each entry."""
    out = np.empty((len(x), len(entries)), np.int64)
    step = max(1, (1 << 21) // max(1, entries.size))  # keeps the differences in 16 MB
    for at in range(0, len(x), step):
        apart = x[at : at + step, None, :] - entries[None, :, :]
        out[at : at + step] = np.einsum("nkd,nkd->nk", apart, apart)
    return out


@dataclass
class Bounds:
    """Assignment and bounds of one part position over a batch of rows."""

    own: np.ndarray
    upper: np.ndarray
    outer: np.ndarray
    near: np.ndarray
    lower: np.ndarray

    @classmethod
    def fresh(cls, x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """From the distances to all entries; of equal distances the lower index is nearer."""
        far = squares(x, entries)
        order = np.argsort(far, axis=1, kind="stable")[:, : b + 2]
        root = np.sqrt(np.take_along_axis(far, order, 1).astype(float))
        rest = _down(root[:, b + 1]) if root.shape[1] > b + 1 else np.full(len(x), np.inf, np.float32)
        return cls(
            order[:, 0].astype(np.uint8), _up(root[:, 0]), rest,
            order[:, 1 : b + 1].astype(np.uint8), _down(root[:, 1 : b + 1]),
        )

    def take(self, rows: np.ndarray) -> Bounds:
        return Bounds(*(getattr(self, f)[rows] for f in self.__dataclass_fields__))

    def put(self, rows: np.ndarray, other: Bounds) -> None:
        for f in self.__dataclass_fields__:
            getattr(self, f)[rows] = getattr(other, f)

    def shift(self, moved: np.ndarray) -> None:
        """The entries have moved by ``moved``: upper bounds grow, lower bounds shrink."""
        self.upper = _up(self.upper + moved[self.own])
        self.lower = _down(self.lower - moved[self.near])
        self.outer = _down(self.outer - moved.max())

    def passed(self) -> np.ndarray:
        """How many of the ordered bounds each upper bound reaches: 0 is certain, b + 1 all."""
        bounds = np.concatenate([self.lower, self.outer[:, None]], axis=1)
        ordered = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        return (self.upper[:, None] >= ordered).sum(axis=1)

    def settle(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Assignments made right; returns for each b: how many parts needed b comparisons."""
        b = self.near.shape[1]
        needed = np.zeros(b + 2, np.int64)
        reach = self.passed()
        unsure = np.flatnonzero(reach)
        if len(unsure):  # a tight upper bound is one comparison, and often enough
            apart = x[unsure] - entries[self.own[unsure]]
            self.upper[unsure] = _up(np.sqrt(np.einsum("nd,nd->n", apart, apart).astype(float)))
            reach[unsure] = self.take(unsure).passed()
        needed += np.bincount(reach, minlength=b + 2)
        for depth in range(1, b + 1):
            rows = np.flatnonzero(reach == depth)
            if len(rows):
                self.put(rows, self.take(rows)._compared(x[rows], entries, depth))
        rows = np.flatnonzero(reach > b)
        if len(rows):
            self.put(rows, Bounds.fresh(x[rows], entries, b))
        return needed

    def _compared(self, x: np.ndarray, entries: np.ndarray, depth: int) -> Bounds:
        """The best of the own entry and the first ``depth`` near ones, all measured."""
        # The bounds count in order, so the near entries are brought into it first.
        order = np.argsort(self.lower, axis=1, kind="stable")
        near, lower = (np.take_along_axis(a, order, 1) for a in (self.near, self.lower))
        tried = np.concatenate([self.own[:, None], near[:, :depth]], axis=1)
        apart = x[:, None, :] - entries[tried]
        far = np.einsum("nkd,nkd->nk", apart, apart)
        by_far = np.lexsort((tried, far), axis=1)
        tried, far = (np.take_along_axis(a, by_far, 1) for a in (tried, far))
        root = np.sqrt(far.astype(float))
        near[:, :depth], lower[:, :depth] = tried[:, 1:], _down(root[:, 1:])
        return Bounds(tried[:, 0], _up(root[:, 0]), self.outer, near, lower)

    def cut(self, b: int) -> Bounds:
        """With the ``b`` nearest only; the others fall under the outer bound."""
        if b >= self.near.shape[1]:
            return self
        order = np.argsort(self.lower, axis=1, kind="stable")
        near, lower = (np.take_along_axis(a, order, 1) for a in (self.near, self.lower))
        return Bounds(
            self.own, self.upper, np.minimum(self.outer, lower[:, b]), near[:, :b], lower[:, :b]
        )


def packed(bounds: list[Bounds]) -> pa.Array:
    """The bounds of all part positions, one binary value a row."""
    n, b = bounds[0].near.shape
    rows = np.empty(n, state_type(len(bounds), b))
    for f in rows.dtype.names:
        rows[f] = np.stack([getattr(x, f) for x in bounds], axis=1)
    return binary_rows(rows)


def unpacked(column: pa.Array, parts: int, b: int) -> list[Bounds]:
    rows = np.frombuffer(b"".join(column.to_pylist()), state_type(parts, b))
    return [Bounds(*(rows[f][:, p].copy() for f in rows.dtype.names)) for p in range(parts)]


def binary_rows(rows: np.ndarray) -> pa.Array:
    """One binary value for each first-axis element of an array."""
    rows = np.ascontiguousarray(rows)
    size = rows.nbytes // len(rows) if len(rows) else 0
    ends = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())]
    )


def whole_vectors(rows: DataFrame, id_col: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, q) of the rows whose vector has no null and no non-finite component."""
    finite = F.forall(
        F.col(f"`{vector}`"),
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    whole = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return rows.where(F.col(f"`{vector}`").isNotNull() & finite).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), whole.alias("q")
    )


def _moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each entry of each part position has moved, rounded up."""
    apart = (new - old).astype(float)
    return np.sqrt((apart * apart).sum(axis=2)) * (1 + 1e-9)


class Coder:
    """The passes over one table of whole vectors of one length."""

    def __init__(self, rows: DataFrame, first: list[list[int]], parts: int, biggest: int):
        self.spark: SparkSession = rows.sparkSession
        self.parts, self.k, self.size = parts, len(first), len(first[0]) // parts
        self.books = np.array(first, np.int64).reshape(self.k, parts, self.size).transpose(1, 0, 2)
        self.sums = np.zeros((parts, self.k, self.size + 1), np.int64)  # the last is the count
        self.kind = np.dtype("<i2") if biggest < 2**15 else np.dtype("<i4")
        #: A quarter of the entries at first; none where there is only one entry.
        self.b = min(max(1, self.k // 4), self.k - 1)
        self.moved: np.ndarray | None = None
        self.table, self.folder = rows, None
        #: Of each pass, how many parts needed 0, 1, ... comparisons, or all.
        self.needed: list[np.ndarray] = []

    def _vectors(self, batch: pa.RecordBatch) -> np.ndarray:
        """(rows, parts, size) of the batch, from lists at first, from bytes later."""
        column = batch.column(2)
        if pa.types.is_binary(column.type):
            flat = np.frombuffer(b"".join(column.to_pylist()), self.kind)
        else:
            flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.astype(np.int64).reshape(-1, self.parts, self.size)

    def assign(self) -> None:
        """One round: every part to its nearest entry, then every entry to its parts' mean."""
        books, moved, b = self.books, self.moved, self.b
        keep, slots = self._next_b(), self.b + 2
        parts, size, kind = self.parts, self.size, self.kind

        def run(batches):
            total = np.zeros((parts, len(books[0]), size + 1), np.int64)
            needed = np.zeros(slots, np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = self._vectors(batch)
                state = unpacked(batch.column(3), parts, b) if moved is not None else [None] * parts
                for p in range(parts):
                    if moved is None:
                        state[p] = Bounds.fresh(x[:, p], books[p], b)
                        needed[-1] += len(x)
                        _add(total[p], x[:, p], state[p].own, 1)
                    else:
                        before = state[p].own.copy()
                        state[p].shift(moved[p])
                        needed += state[p].settle(x[:, p], books[p])
                        other = np.flatnonzero(before != state[p].own)
                        _add(total[p], x[other, p], before[other], -1)
                        _add(total[p], x[other, p], state[p].own[other], 1)
                    state[p] = state[p].cut(keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1),
                        binary_rows(x.reshape(len(x), -1).astype(kind)), packed(state),
                        pa.nulls(len(x), pa.list_(pa.int64())),
                    ],
                    names=["id", "label", "q", "state", "total"],
                )
            both = np.concatenate([total.ravel(), needed]).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(1, ids), pa.nulls(1, labels), pa.nulls(1, pa.binary()),
                    pa.nulls(1, pa.binary()), pa.array([both], pa.list_(pa.int64())),
                ],
                names=["id", "label", "q", "state", "total"],
            )

        names = {f.name: f.dataType for f in self.table.schema}
        ids, labels = to_arrow_type(names["id"]), to_arrow_type(names["label"])
        schema = (
            f"id {names['id'].simpleString()}, label {names['label'].simpleString()}, "
            "q binary, state binary, total array<long>"
        )
        folder, out = saved(self.table.mapInArrow(run, schema), "codes-pass")
        if self.folder:
            forget(self.spark, self.folder)  # nothing reads the pass before the last
        self.folder = folder
        self.table = out.where("total IS NULL").select("id", "label", "q", "state")
        summed = (
            out.where("total IS NOT NULL")
            .select(F.posexplode("total").alias("at", "x"))
            .groupBy("at")
            .agg(F.sum("x").alias("x"))
            .collect()  # one number per component of an entry, whatever the number of rows
        )
        both = np.zeros(self.sums.size + slots, np.int64)
        for r in summed:
            both[r["at"]] = r["x"]
        self.sums += both[: self.sums.size].reshape(self.sums.shape)
        self.needed.append(both[self.sums.size :])
        self.b = min(keep, b)
        counts = self.sums[:, :, -1:]
        means = self.sums[:, :, :-1] // np.maximum(counts, 1)  # rounds down
        new = np.where(counts > 0, means, books)
        self.moved, self.books = _moved(books, new), new

    def _next_b(self) -> int:
        """How many near entries the rows keep: what nearly all comparisons needed last."""
        if len(self.needed) < 2:  # the first pass measures all
            return self.b
        some = self.needed[-1][1 : self.b + 1]
        if not some.sum():
            return max(1, self.k // 8)
        enough = int(np.searchsorted(np.cumsum(some), ENOUGH * some.sum())) + 1
        return min(self.b, max(enough, self.k // 8))

    def codes(self) -> DataFrame:
        """(id, label, code, error) by the entries as they are now."""
        books, moved, b, parts = self.books, self.moved, self.b, self.parts
        hexes = np.array([f"{e:02x}" for e in range(256)])

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = self._vectors(batch)
                state = unpacked(batch.column(3), parts, b)
                code, error = np.full(len(x), "", "<U1"), np.zeros(len(x), np.int64)
                for p in range(parts):
                    state[p].shift(moved[p])
                    state[p].settle(x[:, p], books[p])
                    apart = x[:, p] - books[p][state[p].own]
                    error += np.einsum("nd,nd->n", apart, apart)
                    code = np.strings.add(code, hexes[state[p].own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(code.tolist(), pa.string()), pa.array(error)],
                    names=["id", "label", "code", "error"],
                )

        names = {f.name: f.dataType.simpleString() for f in self.table.schema}
        return self.table.mapInArrow(
            run, f"id {names['id']}, label {names['label']}, code string, error long"
        )

    def __getstate__(self) -> dict:
        """What tasks need: the shape, not the session."""
        return {f: getattr(self, f) for f in ("parts", "size", "kind")}


def _add(total: np.ndarray, x: np.ndarray, entry: np.ndarray, sign: int) -> None:
    for e in np.unique(entry):
        of = x[entry == e]
        total[e, :-1] += sign * of.sum(axis=0)
        total[e, -1] += sign * len(of)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """id, code, error, label_error, codebooks_sha256 of every row with a whole vector.

    Components become floor(scale * x). A codebook starts as its part of the vectors with
    the ``entries`` smallest ids (null ids last, ties by vector; all rows if there are
    fewer), and goes through ``rounds`` rounds. ``code`` has two hex digits a part,
    ``error`` is the squared distance to the coded vector, ``label_error`` its sum over
    rows of the same label, null labels together.

    Rows whose vector is null or has a null or non-finite component are dropped. All
    others must have one length, a multiple of ``parts``, and components small enough for
    64-bit sums: ValueError says so otherwise. Repeated rows and ids are rows of their own.
    An empty table gives an empty one.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    whole = whole_vectors(rows, id_col, vector, label, scale)
    size = F.size("q")
    seen = whole.agg(
        F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most"),
        F.max(F.greatest(F.array_max("q"), F.bitwise_not(F.array_min("q")))).alias("biggest"),
    ).first()
    if not seen["n"]:
        return rows.sparkSession.createDataFrame(
            [], f"`{id_col}` {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    length, biggest = seen["most"], (seen["biggest"] or 0) + 1
    if seen["least"] != length or not length or length % parts:
        raise ValueError(f"vectors have {seen['least']} to {length} components, not one multiple of {parts}")
    if 4 * biggest**2 * length >= 2**62 or biggest * seen["n"] >= 2**62 or biggest >= 2**31:
        raise ValueError(f"components up to {biggest} are too large for 64-bit sums")
    start = (  # at most ``entries`` vectors
        whole.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    )
    coder = Coder(whole, [r["q"] for r in start], parts, biggest)
    for _ in range(rounds):
        coder.assign()
    coded = written(coder.codes(), "codes-coded")
    forget(coder.spark, coder.folder)
    return with_label_error(coded).select(
        F.col("id").alias(id_col), "code", "error", "label_error",
        F.lit(books_digest(coder.books)).alias("codebooks_sha256"),
    )


def with_label_error(coded: DataFrame, few: int = FEW_LABELS) -> DataFrame:
    """Adds the sum of ``error`` over the rows of a label; a hot label is no hot task."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    sums = sums.withColumnRenamed("label", "_label")
    same: Column = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= few:
        return coded.join(F.broadcast(sums), same)
    salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn("_of", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("_of") == F.col("_salt")))
