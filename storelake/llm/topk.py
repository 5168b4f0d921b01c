"""Exact top-k inner-product search by a ball tree in every shard.

Candidates are dealt by row hash to shards of bounded size, each with a ball tree. Query
rows are dealt to blocks of bounded size. A block first searches one home shard, whose
kth scores it then takes along to all other shards. These it meets in tiles: some shards
and some blocks, as many as a task's memory holds. The shards of a tile hand the current
kth scores on. Vectors move as rows, once for each tile they are in; trees are planted
where they are searched. No row grows with the tables, and no join is left to a size
estimate, which would not see that a vector is in many tiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.common import written

LOW = np.iinfo(np.int64).min
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 4096, 512, 64
#: Bytes of the vectors that a tile has from its shards, and from its blocks; tiles a core.
TILE_BYTES, TILES_A_CORE = 64 << 20, 4
FOUND = ["query_row", "query_id", "vec_id", "score"]


@dataclass
class BallTree:
    """Points in tree order; node i holds points[first[i]:last[i]] inside a ball."""

    ids: np.ndarray
    rows: np.ndarray
    points: np.ndarray
    first: list[int]
    last: list[int]
    left: list[int]
    right: list[int]
    centers: np.ndarray
    radii: np.ndarray

    @staticmethod
    def build(
        ids: np.ndarray, rows: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS
    ) -> BallTree:
        order = np.arange(len(ids))
        first, last, left, right, centers, radii = [], [], [], [], [], []

        def node(a: int, b: int) -> int:
            me, own = len(first), points[order[a:b]]
            center = own.mean(axis=0)
            away = np.sqrt(((own - center) ** 2).sum(axis=1))
            first.append(a), last.append(b), left.append(-1), right.append(-1)
            centers.append(center), radii.append(away.max())
            if b - a > leaf and radii[me] > 0:
                # Split at the median along the line between two points far apart.
                p = own[away.argmax()]
                q = own[((own - p) ** 2).sum(axis=1).argmax()]
                order[a:b] = order[a:b][np.argsort(own @ (q - p), kind="stable")]
                middle = (a + b) // 2
                left[me] = node(a, middle)
                right[me] = node(middle, b)
            return me

        node(0, len(ids))
        return BallTree(
            ids[order], rows[order], points[order], first, last, left, right,
            np.array(centers), np.array(radii),
        )


class Search:
    """Branch and bound for a block of queries, tree by tree; ``kth`` only ever rises."""

    def __init__(self, rows: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray):
        self.rows, self.queries, self.k, self.kth = rows, queries, k, kth.copy()
        self.norms = np.sqrt((queries**2).sum(axis=1))
        # Rounding: every product and sum below is of at most this relative size.
        self.slack = 1e-9 * (1.0 + self.norms)
        self.best = np.full((len(rows), k), LOW)
        self.best_ids = np.full((len(rows), k), np.iinfo(np.int64).max)

    def run(self, tree: BallTree) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the best k of all trees so far that may still count; LOW if none."""
        self.queries, points = _fit_width(self.queries, tree.points)
        if points.shape[1] != tree.points.shape[1]:
            centers = np.pad(tree.centers, ((0, 0), (0, points.shape[1] - tree.centers.shape[1])))
            tree = replace(tree, points=points, centers=centers)
        self.tree = tree
        # Whole numbers below 2**53 are exact in floating point; else count in integers.
        size = np.abs(tree.points).max(initial=0) * np.abs(self.queries).max(initial=0)
        self.exact = size * max(1, self.queries.shape[1]) < 2**53
        self.own = np.isin(self.rows, tree.rows).any()
        every = np.arange(len(self.rows))
        if len(every) and len(tree.ids):
            self.bounds = self._bound(slice(None), every)
            self.seen = np.full(len(every), -1)
            self._descend(0, every)
            self._visit(0, every)
        return self.best, self.best_ids

    def _bound(self, node: int | slice, q: np.ndarray) -> np.ndarray:
        """No score of a query with a point of the node is larger; of many nodes a column each."""
        centers, radii = self.tree.centers[node], self.tree.radii[node]
        size = 1.0 + radii + np.sqrt((centers**2).sum(axis=-1))
        reach = np.multiply.outer(self.norms[q], radii) + np.multiply.outer(self.slack[q], size)
        return self.queries[q] @ centers.T + reach

    def _descend(self, node: int, q: np.ndarray) -> None:
        """Each query to one leaf, by the child with the larger bound."""
        a, b = self.tree.left[node], self.tree.right[node]
        if a < 0:
            go = q[self.bounds[q, node] >= self.kth[q]]
            self.seen[go] = node
            self._leaf(node, go)
            return
        a_first = self.bounds[q, a] >= self.bounds[q, b]
        for child, go in ((a, q[a_first]), (b, q[~a_first])):
            if len(go):
                self._descend(child, go)

    def _visit(self, node: int, q: np.ndarray) -> None:
        """All other leaves, each once for all queries that no bound keeps from it."""
        # A bound equal to the kth score still counts, as a smaller id wins a tie.
        q = q[self.bounds[q, node] >= self.kth[q]]
        if not len(q):
            return
        if self.tree.left[node] < 0:
            self._leaf(node, q[self.seen[q] != node])
            return
        self._visit(self.tree.left[node], q)
        self._visit(self.tree.right[node], q)

    def _scores(self, q: np.ndarray, rows: slice) -> np.ndarray:
        """Whole numbers, as doubles where these are exact."""
        points = self.tree.points[rows]
        if self.exact:
            return self.queries[q] @ points.T
        wide = np.array([[int(x) for x in r] for r in self.queries[q]], object)
        products = wide @ np.array([[int(x) for x in r] for r in points], object).T
        return np.clip(products, LOW + 1, np.iinfo(np.int64).max).astype(np.int64)

    def _leaf(self, node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        rows = slice(self.tree.first[node], self.tree.last[node])
        scores = self._scores(q, rows)
        if self.own:
            same = self.tree.rows[rows][None, :] == self.rows[q][:, None]
            scores = np.where(same, scores.dtype.type(LOW), scores)
        # Only a score that reaches the kth can change what is found; most leaves have none.
        some = (scores >= self.kth[q][:, None]).any(axis=1)
        q, scores = q[some], scores[some].astype(np.int64)
        if not len(q):
            return
        ids = np.broadcast_to(self.tree.ids[rows], scores.shape)
        scores = np.concatenate([self.best[q], scores], axis=1)
        ids = np.concatenate([self.best_ids[q], ids], axis=1)
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]
        self.best[q] = np.take_along_axis(scores, order, 1)
        self.best_ids[q] = np.take_along_axis(ids, order, 1)
        low = self.best[q, -1]
        self.kth[q] = np.maximum(self.kth[q], np.where(low == LOW, -np.inf, low.astype(float)))


def quantized(rows: DataFrame, vector: str) -> DataFrame:
    """(vec_id, row, v): floor(256 * x) of each component as a whole double.

    ``row`` tells rows apart that repeat an id; it holds once the result is stored. Null
    vectors, vectors with a null or non-finite component and rows without an id take no
    part.
    """
    # floor() gives 64-bit numbers; beyond 2 ** 52 a double is whole already.
    wide = F.transform(
        F.col(vector),
        lambda x: F.when(
            F.abs(x.cast("double")) < 2.0**44, F.floor(256 * x.cast("double")).cast("double")
        ).otherwise(256 * x.cast("double")),
    )
    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    kept = rows.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        wide.alias("v"),
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    vectors = column.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(
        np.cumsum(sizes) - sizes, sizes
    )] = flat
    return out


def _fit_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def _parts(table: pa.Table, name: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each value of a column, by rising value."""
    values = table[name].to_numpy()
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(values[rows[0]]), table.take(pa.array(rows))


def _tree(shard: pa.Table) -> BallTree:
    return BallTree.build(shard["vec_id"].to_numpy(), shard["row"].to_numpy(), _matrix(shard["v"]))


def _found(search: Search, block: pa.Table) -> list[np.ndarray]:
    """The columns of FOUND: what may still count of what a block has found."""
    keep = (search.best != LOW) & (search.best >= block["kth"].to_numpy()[:, None])
    at = np.nonzero(keep)[0]
    rows, ids = (block[x].to_numpy()[at] for x in ("row", "vec_id"))
    return [rows, ids, search.best_ids[keep], search.best[keep]]


def _numbers(columns: list[np.ndarray], names: list[str]) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of every query row.

    ``is_query`` is a condition on vec_id. Score: the inner product of the quantized
    vectors; ties go to the smaller vec_id; fewer rows if there are fewer candidates.
    Rows that repeat an id are queries and candidates of their own: a query's ranks are
    its own, and it finds the other rows of its id like any.
    Vectors of unequal length are compared as if filled up with zeros. Scores beyond 64
    bits are cut to the nearest value that fits.
    """
    vectors = written(quantized(rows, vector), "topk-vectors")
    queries = vectors.where(is_query)
    whole = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    shards = max(1, -(-whole["n"] // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    each = 8 * max(1, whole["width"] or 0)
    up = -(-blocks // max(1, TILE_BYTES // (block_rows * each)))
    least = -(-shards // max(1, TILE_BYTES // (shard_rows * each)))
    enough = TILES_A_CORE * rows.sparkSession.sparkContext.defaultParallelism
    across = min(shards, max(least, -(-enough // up)))

    def deal(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        """The blocks at home in a shard, with kth scores and what they have found there."""
        tree, parts = _tree(right) if left.num_rows and right.num_rows else None, []
        for _, block in _parts(left, "block"):
            search = Search(block["row"].to_numpy(), _matrix(block["v"]), k, block["kth"].to_numpy())
            if tree is not None:
                search.run(tree)
            seen = search.best != LOW
            ends = np.concatenate([[0], np.cumsum(seen.sum(axis=1))]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(x[seen], pa.int64()))
                for x in (search.best_ids, search.best)
            ]
            kth = block.schema.get_field_index("kth")
            block = block.set_column(kth, "kth", pa.array(search.kth, pa.float64()))
            parts.append(
                block.select(["block", "row", "vec_id", "v", "kth"])
                .append_column("ids", lists[0])
                .append_column("scores", lists[1])
            )
        if parts:
            return pa.concat_tables(parts)
        none = left.select(["block", "row", "vec_id", "v", "kth"])
        empty = pa.array([], pa.list_(pa.int64()))
        return none.append_column("ids", empty).append_column("scores", empty)

    def rest(left: pa.Table, right: pa.Table) -> pa.Table:
        """What the blocks of a tile find in its shards, but for their home."""
        out = [[np.zeros(0, np.int64)] * len(FOUND)]
        trees = [(shard, _tree(part)) for shard, part in _parts(right, "shard")] if left.num_rows else []
        for number, block in _parts(left, "block"):
            search = Search(block["row"].to_numpy(), _matrix(block["v"]), k, block["kth"].to_numpy())
            for shard, tree in trees:
                if shard != number % shards:
                    search.run(tree)
            out.append(_found(search, block))
        return _numbers([np.concatenate(c) for c in zip(*out, strict=True)], FOUND)

    started = written(
        queries.select("row", "vec_id", "v", deal(blocks).alias("block"))
        .withColumns({"kth": F.lit(float("-inf")), "home": F.col("block") % shards})
        .groupBy("home")
        .cogroup(vectors.withColumn("home", deal(shards)).groupBy("home"))
        .applyInArrow(
            first,
            "block int, row long, vec_id long, v array<double>, kth double, ids array<long>, "
            "scores array<long>",
        ),
        "topk-home",
    )
    # A tile is a place in a grid: blocks by their number modulo ``up``, shards modulo ``across``.
    asking = started.select("block", "row", "vec_id", "v", "kth", every(across).alias("x"))
    asked = vectors.withColumn("shard", deal(shards)).select("*", every(up).alias("y"))
    later = (
        asking.withColumn("tile", F.col("block") % up * across + F.col("x"))
        .groupBy("tile")
        .cogroup(asked.withColumn("tile", F.col("y") * across + F.col("shard") % across).groupBy("tile"))
        .applyInArrow(rest, ", ".join(f"{c} long" for c in FOUND))
    )
    found = started.select(
        F.col("row").alias("query_row"),
        F.col("vec_id").alias("query_id"),
        F.explode(F.arrays_zip("ids", "scores")).alias("x"),
    ).select("query_row", "query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.unionByName(later)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
