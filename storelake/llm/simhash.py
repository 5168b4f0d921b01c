"""SimHash near duplicates by pivot distance tables.

A fingerprint's row of the table holds its Hamming distances to PIVOTS reference
fingerprints. By the triangle inequality, two fingerprints within d bits differ by at
most d in every coordinate, so a pair with a larger coordinate difference is discarded
without a look at its bits. Survivors are verified.

The pairs that are looked at are those of one table block: within d bits, at least two
of four 16-bit blocks agree, so every linked pair meets under one of six 32-bit keys.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import few_tasks, text_of, written
from storelake.llm.components import connected_components

SHINGLE, SEED, NEAR = 3, 42, 2
BLOCKS, BLOCK_BITS = 4, 16
#: The pairs of blocks whose bits are a key of the table.
TABLES = list(combinations(range(BLOCKS), 2))
PIVOTS = 32
#: Blocks of the table with more fingerprints than this take the exact way for the rest.
MOST_IN_BLOCK = 512
#: Fingerprints whose pairs a task holds at once, unless one block has more.
MOST_AT_ONCE = 1 << 14
#: The reference fingerprints: seeded, so that every task has the same ones.
REFERENCES = np.random.default_rng(SEED).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of all runs of ``shingle`` words, repeats included; none without words."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    starts = list(accumulate(map(len, words), lambda a, n: a + n + 1, initial=0))
    pieces = zip(starts, starts[shingle:], strict=False)
    return np.array(
        [xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in pieces], dtype="<u8"
    )


def bits_of(hashes: np.ndarray) -> int:
    """The 64 majority bits of the hashes; 0 without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text; 0 without words."""
    return bits_of(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, fp) of every row: a hash of the text and its signed 64-bit fingerprint."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(text_of(text_col)).alias("key"),
        text_of(text_col).cast("binary").alias("text"),
    )

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["id", "key", "fp"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, key long, fp long")


def pivot_table(fps: DataFrame) -> DataFrame:
    """(fp, coords): the distances of each fingerprint to the references, a byte each."""

    def run(batches):
        for b in batches:
            own = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            far = np.bitwise_count(own[:, None] ^ REFERENCES[None, :]).astype(np.uint8)
            coords = pa.array([row.tobytes() for row in far], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), coords], names=["fp", "coords"])

    return fps.select("fp").mapInArrow(run, "fp long, coords binary")


def near_pairs(
    group: np.ndarray, fp: np.ndarray, coords: np.ndarray, near: int = NEAR
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of one group within ``near`` bits.

    Rows are sorted by group and first coordinate, and each is compared with its next
    row, the one after, and so on, all groups at once. A row drops out where the group
    ends or the first coordinate is more than ``near`` away.
    """
    order = np.lexsort((coords[:, 0], group))
    group, fp, coords = group[order], fp[order], coords[order].astype(np.int16)
    left, right, alive, step = [], [], np.arange(len(fp)), 1
    while True:
        alive = alive[alive + step < len(fp)]
        other = alive + step
        keep = (group[alive] == group[other]) & (coords[other, 0] - coords[alive, 0] <= near)
        alive, other = alive[keep], other[keep]
        if not len(alive):
            break
        close = np.abs(coords[alive] - coords[other]).max(axis=1) <= near
        i, j = alive[close], other[close]
        sure = np.bitwise_count(fp[i] ^ fp[j]) <= near
        left.append(order[i[sure]])
        right.append(order[j[sure]])
        step += 1
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def spanning_links(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A subset of the pairs that joins the same positions: no more than a forest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        if (ra := root(a)) != (rb := root(b)):
            parent[ra] = rb
            out.append((a, b))
    return out


def block_runs(sizes: np.ndarray, most: int = MOST_AT_ONCE) -> list[tuple[int, int]]:
    """Runs (first, end) of blocks that follow each other, of ``most`` fingerprints or one block."""
    out, first, held = [], 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > first and held + size > most:
            out.append((first, at))
            first, held = at, 0
        held += size
    return [*out, (first, len(sizes))] if len(sizes) else []


def _block(i: int) -> Column:
    return F.shiftrightunsigned("fp", i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def links(
    nodes: DataFrame, most_in_block: int = MOST_IN_BLOCK, most_nodes: int | None = None
) -> DataFrame:
    """Links (a, b) that join all fingerprints within NEAR bits; ``nodes`` are distinct.

    Not every near pair is a row: those of one table block come as a spanning forest.
    A block with more than ``most_in_block`` fingerprints is worked on through midpoints:
    two fingerprints within two bits share one that is at most one bit from either, and
    any two that share one are within two bits. So each fingerprint goes to 65 keys; a
    key holds at most 65 fingerprints, which are hung on its smallest. That is exact too,
    but costs 65 rows a fingerprint, so it is kept for crowded blocks.
    """
    table = written(pivot_table(nodes), "simhash-pivots")
    keys = [
        F.struct(F.lit(k).alias("k"), F.shiftleft(_block(i), BLOCK_BITS).bitwiseOR(_block(j)).alias("v"))
        for k, (i, j) in enumerate(TABLES)
    ]
    keyed = table.withColumn("key", F.explode(F.array(*keys)))
    counts = keyed.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    if most_nodes is not None:  # a block of two or more for every two rows of the table at most
        counts = few_tasks(counts, len(keys) * most_nodes // 2)
    counts = written(counts, "simhash-blocks")
    small = keyed.join(counts.where(F.col("held") <= most_in_block), "key")
    blocks = small.groupBy("key").agg(F.collect_list(F.struct("fp", "coords")).alias("held"))

    def run(batches):
        for b in batches:
            all_sizes = np.diff(b.column(0).offsets.to_numpy())
            for first, end in block_runs(all_sizes):
                sizes, flat = all_sizes[first:end], b.column(0).slice(first, end - first).flatten()
                fp = flat.field("fp").to_numpy(zero_copy_only=False)
                raw = b"".join(flat.field("coords").to_pylist())
                coords = np.frombuffer(raw, np.uint8).reshape(-1, PIVOTS)
                group = np.repeat(np.arange(len(sizes)), sizes)
                forest = spanning_links(*near_pairs(group, fp.view(np.uint64), coords))
                a = fp[[x for x, _ in forest]] if forest else fp[:0]
                c = fp[[y for _, y in forest]] if forest else fp[:0]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])

    sparse = blocks.select("held").mapInArrow(run, "a long, b long")
    crowded = (
        keyed.join(counts.where(F.col("held") > most_in_block), "key", "left_semi")
        .select("fp")
        .distinct()
    )
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    midpoints = crowded.select(
        "fp", F.explode(F.concat(F.array("fp"), flips)).alias("midpoint")
    )
    stars = midpoints.groupBy("midpoint").agg(F.collect_list("fp").alias("of"))
    dense = stars.where(F.size("of") > 1).select(
        F.array_min("of").alias("a"), F.explode("of").alias("b")
    )
    return sparse.unionByName(dense.where("a <> b").distinct())


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(id, key, fp, component_id) of every row, and how many rows there are."""
    prints = written(fingerprints(docs, id_col, text_col), "simhash-prints")
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    rows = prints.count()
    nodes = written(few_tasks(least, rows), "simhash-nodes")
    held = nodes.count()
    # The links of a block are a forest: fewer than its fingerprints, unless it is crowded.
    roots = connected_components(links(nodes, most_nodes=held), len(TABLES) * held)
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(few_tasks(rooted, held), "simhash-roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).drop("_fp"), rows


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id that the document reaches over fingerprints within
    two bits, its own included. Nulls count as the empty text; texts without words have
    fingerprint zero and link like any others. Null ids never are the smallest; a
    component of null ids only has a null component_id. Rows that repeat an id are rows
    of their own. Equal fingerprints are one node, so copies never become pairs.
    """
    return _labelled(docs, id_col, text_col)[0].select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows that repeat an id within a component count as one document and stay or go
    together. A component of null ids only stays whole.
    """
    labelled, rows = _labelled(docs, id_col, text_col)
    return without_others(docs, labelled, id_col, text_col, rows)


def without_others(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_rows: int | None = None,
) -> DataFrame:
    """``docs`` without the rows of (id, key) whose component is named after another id.

    What goes is stored first: Spark then knows its size before it moves any text, and
    moves none where the ids are few enough to send to all tasks.
    """
    others = (
        labelled.where(~F.col("id").eqNullSafe(F.col("component_id")))
        .select(F.col("id").alias("_id"), F.col("key").alias("_key"))
        .distinct()
    )
    away = written(
        others if most_rows is None else few_tasks(others, most_rows), "simhash-away"
    )
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        F.col(f"`{id_col}`").alias("_of"),
        F.xxhash64(text_of(text_col)).alias("_hash"),
    )
    same = F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key"))
    return rows.join(away, same, "left_anti").select(
        *[F.col("_row").getField(c).alias(c) for c in names]
    )
