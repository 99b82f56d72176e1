"""Exact top-k search by inner product over KD-trees, one per shard.

Vectors are dealt to shards by hash; every shard becomes a tree by median splits,
with the tight bounding box of each node. A query walks a tree best-first: the bound
of a node is the largest inner product a point of its box can have, and a node whose
bound is below the k-th score found so far is left. Blocks of queries search one shard
first, and its k-th scores go along to all other shards: cells of a few shards and a
bounded number of blocks are shuffled together, so that nothing goes through the driver.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import materialize

K = 10
LEAF_ROWS = 64
SHARD_ROWS = 4096
BLOCK_QUERIES = 256

#: Query blocks that meet the shards of a cell, and the shards of one where there are many.
CELL_BLOCKS = 64
CELL_SHARDS = 16

#: Cells that a group of blocks is sent to; from there on cells have more shards.
LEAST_CELLS = 256

#: Stands for "no k-th score yet".
NO_BOUND = np.iinfo(np.int64).min


class Tree:
    """Points in tree order with the boxes of a complete binary tree of nodes (1 is the root)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.levels = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF_ROWS))))
        order = np.arange(len(ids))
        self.borders = {1: (0, len(ids))}
        for node in range(1, 1 << self.levels):
            a, b = self.borders[node]
            own = order[a:b]
            middle = (b - a) // 2
            if b - a > 1:
                spread = points[own].max(axis=0) - points[own].min(axis=0)
                own = own[np.argpartition(points[own, int(spread.argmax())], middle)]
                order[a:b] = own
            self.borders[2 * node], self.borders[2 * node + 1] = (a, a + middle), (a + middle, b)
        self.ids, self.points = ids[order], points[order]
        size = 2 << self.levels
        self.low, self.high = np.zeros((size, points.shape[1]), np.int64), np.zeros((size, points.shape[1]), np.int64)
        for node, (a, b) in self.borders.items():
            if b > a:
                self.low[node], self.high[node] = self.points[a:b].min(axis=0), self.points[a:b].max(axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product of each query with a point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, reach: int) -> tuple[list[tuple[int, int]], int]:
        """Up to k (score, -id) of the tree that may belong to the k best, and the points looked at."""
        best: list[tuple[int, int]] = []
        waiting, looked = [(-int(bounds[1]), 1)], 0
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < max(reach, best[0][0] if len(best) == k else NO_BOUND):
                break
            a, b = self.borders[node]
            if node < 1 << self.levels:
                for child in (2 * node, 2 * node + 1):
                    if self.borders[child][0] < self.borders[child][1]:
                        heapq.heappush(waiting, (-int(bounds[child]), child))
                continue
            looked += b - a
            scores = self.points[a:b] @ query
            for i in np.flatnonzero(scores >= max(reach, best[0][0] if len(best) == k else NO_BOUND)):
                if self.ids[a + i] != query_id:
                    found = (int(scores[i]), -int(self.ids[a + i]))
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
        return best, looked


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``point``: floor(1024 x) of each component; rows with a null id or vector, or a null or non-finite component, are left out."""
    value = vectors[vector_col].cast("array<double>")
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(vectors[id_col].isNotNull() & vectors[vector_col].isNotNull()).where(sound)
    return rows.select(vectors[id_col].cast("long").alias("vec_id"), F.transform(value, lambda x: F.floor(1024 * x)).alias("point"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Points as rows; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def _packed(matrix: np.ndarray) -> bytes:
    """The numbers of a matrix in the fewest bytes each that hold them all."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return matrix.astype(kind).tobytes()


def _unpacked(packed: bytes, rows: int, width: int) -> np.ndarray:
    size = len(packed) // max(1, rows * width) or 8
    return np.frombuffer(packed, f"i{size}").reshape(rows, width).astype(np.int64)


def nearest(points: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k points with the largest inner product, ties to the smaller id.

    A query's own id is no candidate. Both frames have ``vec_id`` and ``point``; vectors of
    another length are compared as if they ended in zeros. Shards and query blocks have
    a bounded number of rows, and a task holds a cell of a bounded number of both; shards are
    sent once for each 64 blocks, a block to some 500 cells until cells have 16 shards.
    """
    points, queries = materialize(points, "points"), materialize(queries, "queries")
    size = points.agg(F.count("*").alias("n"), F.max(F.size("point")).alias("width")).first()
    wide = queries.agg(F.count("*").alias("n"), F.max(F.size("point")).alias("width")).first()
    width = max(size["width"] or 0, wide["width"] or 0)
    shards, blocks = -(-size["n"] // SHARD_ROWS) or 1, -(-wide["n"] // BLOCK_QUERIES) or 1

    def pack(table: pa.Table) -> pa.Table:
        ids, block = table.column("vec_id").to_numpy(), _matrix(table.column("point").combine_chunks(), width)
        return pa.table([pa.array([x], t) for x, t in zip((table.column(0)[0].as_py(), len(ids), ids.tobytes(), _packed(block)), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["part", "n", "ids", "packed"])

    def packed(rows: DataFrame, parts: int) -> DataFrame:
        dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part"), "vec_id", "point")
        return dealt.groupBy("part").applyInArrow(pack, "part long, n long, ids binary, packed binary")

    shard = packed(points, shards).toDF("shard", "n", "ids", "points")
    shard = materialize(shard, "shards")
    block = materialize(packed(queries, blocks).toDF("block", "m", "query_ids", "queries"), "blocks")
    home = F.pmod("block", F.lit(shards))

    def search(trees: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        waiting = [
            (row, np.frombuffer(row["query_ids"], np.int64), _unpacked(row["queries"], row["m"], width), np.frombuffer(row["reach"], np.int64).copy() if row["reach"] else np.full(row["m"], NO_BOUND))
            for row in asked.to_pylist()
        ]
        for i in range(trees.num_rows if waiting else 0):
            row = trees.slice(i, 1).to_pylist()[0]
            tree = Tree(np.frombuffer(row["ids"], np.int64), _unpacked(row["points"], row["n"], width))
            for block, ids, queries, reach in waiting:
                if row["shard"] == block["done"]:
                    continue
                bounds = tree.bounds(queries)
                for q in range(len(ids)):
                    found, _ = tree.search(int(ids[q]), queries[q], bounds[q], k, int(reach[q]))
                    if len(found) == k:
                        reach[q] = max(int(reach[q]), found[0][0])
                    out += [(block["block"], int(ids[q]), -i, s) for s, i in found]
        columns = zip(*out) if out else [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["block", "query_id", "vec_id", "score"])

    def searched(trees: DataFrame, asked: DataFrame) -> DataFrame:
        schema = "block long, query_id long, vec_id long, score long"
        return trees.groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(search, schema)

    at_home = block.select(home.alias("cell"), "*", F.lit(None).cast("binary").alias("reach"), F.lit(None).cast("long").alias("done"))
    first = materialize(searched(shard.select(F.col("shard").alias("cell"), "*"), at_home), "first")

    def reach_of(asked: pa.Table, found: pa.Table) -> pa.Table:
        scores: dict[int, list[int]] = {}
        for q, s in zip(found.column("query_id").to_pylist(), found.column("score").to_pylist()):
            scores.setdefault(q, []).append(s)
        row = asked.to_pylist()[0]
        ids = np.frombuffer(row["query_ids"], np.int64).tolist()
        reach = np.array([min(scores[q]) if len(scores.get(q, ())) == k else NO_BOUND for q in ids], np.int64)
        return asked.append_column("reach", pa.array([reach.tobytes()], pa.binary()))

    told = block.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(reach_of, "block long, m long, query_ids binary, queries binary, reach binary")
    told = materialize(told, "reach")
    # A cell is some shards and a group of blocks; a block is sent to every cell of its group.
    together = min(CELL_SHARDS, -(-shards // LEAST_CELLS))
    columns, groups = -(-shards // together), -(-blocks // CELL_BLOCKS)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    cell = F.floor(F.col("shard") / together) * groups + F.col("group")
    trees = shard.withColumn("group", every(groups)).select(cell.alias("cell"), *shard.columns)
    cell = F.col("column") * groups + F.pmod("block", F.lit(groups))
    asked = told.withColumn("column", every(columns)).select(cell.alias("cell"), *told.columns, home.alias("done"))
    rest = searched(trees, asked)

    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_step: int = 100, k: int = K) -> DataFrame:
    """The k nearest of every vector whose id is divisible by ``query_step``, among all vectors.

    Repeated rows are candidates as often as they stand there, and a repeated query has the
    results of one. An empty table gives no rows.
    """
    points = integer_vectors(vectors, id_col, vector_col)
    queries = points.where(F.col("vec_id") % query_step == 0).dropDuplicates(["vec_id"])
    return nearest(points, queries, k)
