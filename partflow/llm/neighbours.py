"""Nearest neighbours by cosine with a vantage-point tree per shard.

Vectors are dealt to shards of about SHARD_ROWS rows by a hash of their id, queries to blocks of about
QUERY_ROWS; a task gets one shard and one block, builds the shard's tree over unit vectors (there the Euclidean
distance orders as the cosine does) and takes all its queries down the tree together. A branch is left out for
a query when the triangle inequality, relaxed by ``factor``, says that it holds nothing nearer than what is
already found: at factor one that is exact, above it branches are left out sooner. Each shard gives every
query its best few, and these are ranked together. Scores are cosines of the original vectors in doubles.

Defined results: vectors that are NULL, empty, zero or hold NULL or a non-finite number take no part, nor do
rows without vec_id; vectors are compared with those of their own length; rows that repeat vec_id and vector
count once, other rows under a query's vec_id are queries of their own and never its neighbours; ties
go to the smaller vec_id; with fewer candidates than asked for, all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, QUERY_ROWS, LEAF = 8192, 4096, 64
#: One is exact.
FACTOR = 1.0
#: Room for rounding where distances decide: sqrt(2 - 2 dot) of parallel vectors is up to about 4e-8.
SLACK = 1e-7


class VantageTree:
    """Points halved again and again by their distance to one of them."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> None:
        self.vectors, self.ids, self.leaf = vectors, ids, leaf
        self.norms = np.sqrt(in_order(vectors * vectors))
        self.units = vectors / self.norms[:, None]
        self.root = self.build(np.argsort(ids, kind="stable"))

    def build(self, rows: np.ndarray) -> tuple:
        if len(rows) <= self.leaf:
            return (rows,)
        vantage = self.units[rows[len(rows) // 2]]
        away = distances(self.units[rows], vantage[None, :])[:, 0]
        order = np.argsort(away, kind="stable")
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        return vantage, away[near[-1]], away[far[0]], self.build(rows[near]), self.build(rows[far])

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the ``k`` nearest of every query, best first; missing ones score -inf."""
        norms = np.sqrt(in_order(queries * queries))
        units = queries / norms[:, None]
        best = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), np.iinfo(np.int64).max)
        rows_at = np.zeros((len(queries), k), np.int64)

        def reach(active: np.ndarray) -> np.ndarray:
            worst = best[active, -1]
            return np.where(np.isinf(worst), np.inf, np.sqrt(np.maximum(0.0, 2 - 2 * worst)))

        def visit(node: tuple, active: np.ndarray) -> None:
            if not len(active):
                return
            if len(node) == 1:
                rows = node[0]
                scores = np.einsum("qd,pd->qp", queries[active], self.vectors[rows]) / (
                    norms[active][:, None] * self.norms[rows][None, :])
                scores[own[active][:, None] == self.ids[rows][None, :]] = -np.inf
                all_scores = np.concatenate((best[active], scores), axis=1)
                all_ids = np.concatenate((found[active], np.broadcast_to(self.ids[rows], scores.shape)), axis=1)
                all_rows = np.concatenate((rows_at[active], np.broadcast_to(rows, scores.shape)), axis=1)
                order = np.lexsort((all_ids, -all_scores))[:, :k]
                rows_at[active] = np.take_along_axis(all_rows, order, 1)
                best[active] = np.take_along_axis(all_scores, order, 1)
                found[active] = np.take_along_axis(all_ids, order, 1)
                return
            vantage, radius, gap, near, far = node
            away = distances(units[active], vantage[None, :])[:, 0]
            inside = away <= (radius + gap) / 2
            visit(near, active[inside])
            visit(far, active[~inside])
            visit(far, active[inside & ((gap - away) * factor <= reach(active) + SLACK)])
            visit(near, active[~inside & ((away - radius) * factor <= reach(active) + SLACK)])

        visit(self.root, np.arange(len(queries)))
        # The scores as they are handed out, their terms summed one after the other.
        for query, place in np.argwhere(np.isfinite(best)):
            row = rows_at[query, place]
            best[query, place] = in_order(queries[query] * self.vectors[row]) / (norms[query] * self.norms[row])
        return best, found


def in_order(terms: np.ndarray) -> np.ndarray:
    """Sums over the last axis, term by term."""
    return np.cumsum(terms, axis=-1)[..., -1]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * np.einsum("qd,pd->qp", a, b)))


def matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, once each."""
    vector = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0))
    return rows.select("vec_id", vector.alias("vector")).dropDuplicates(["vec_id", "vector"])


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR,
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` rows of ``embeddings`` nearest to each row of ``queries``.

    Both have vec_id and embedding.
    """
    vectors, asked = usable(embeddings), usable(queries)
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))
    keyed = vectors.withColumn("dim", F.size("vector")).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    placed = keyed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    sent = (asked.withColumn("dim", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
            .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
            .withColumn("mark", F.xxhash64("vector")))
    schema = "query_id long, mark long, vec_id long, score double"
    names = ["query_id", "mark", "vec_id", "score"]

    def search(rows: pa.Table, block: pa.Table) -> pa.Table:
        if not len(rows) or not len(block):
            return pa.table([pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())], names)
        tree = VantageTree(matrix(rows), rows.column("vec_id").to_numpy())
        own, marks = block.column("vec_id").to_numpy(), block.column("mark").to_numpy()
        scores, ids = tree.search(matrix(block), own, k, factor)
        there = np.isfinite(scores)
        times = there.sum(axis=1)
        return pa.table([np.repeat(own, times), np.repeat(marks, times), ids[there], scores[there]], names)

    keys = ["dim", "shard", "block"]
    near = placed.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_fiftieths(embeddings: DataFrame) -> DataFrame:
    """The 5 nearest rows of every row whose vec_id is divisible by 50."""
    return nearest(embeddings, embeddings.where(F.col("vec_id") % 50 == 0), 5)
