"""Exact search for the highest inner products with ball trees.

The rows are dealt out to shards, each with a ball tree of its own. A query goes
through a tree from the nodes with the highest bound on the inner product (centre
product plus query norm times radius) to the lowest and stops at the first node
whose bound is below its current kth score. Every query first searches one shard;
the kth score found there is shared with all others as their starting point. The
winners of all shards are then ranked.

Queries travel in blocks: a task searches one shard for one block, so neither the
queries nor the rows are ever in one place as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value
from listingloom.llm.vectors import usable
from listingloom.storage import stage

#: Rows of a shard and queries of a block, about.
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
LEAF_ROWS = 128


class BallTree:
    """Nodes as arrays, root first, parents before children; leaves own runs of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        places = np.arange(len(ids))
        self.centres, self.radii, self.parents, self.leaves = [], [], [], []
        taken, waiting = [], [(places, -1)]
        filled = 0
        while waiting:
            rows, parent = waiting.pop()
            own = vectors[rows]
            centre = own.mean(axis=0)
            distances = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.centres)
            self.centres.append(centre)
            self.radii.append(distances.max())
            self.parents.append(parent)
            if len(rows) <= LEAF_ROWS:
                taken.append(rows)
                self.leaves.append((node, filled, filled + len(rows)))
                filled += len(rows)
                continue
            # Two far ends, and an even split along the line between them, so that equal rows split as well.
            one = own[distances.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = np.argsort(own @ (other - one), kind="stable")
            half = len(rows) // 2
            waiting += [(rows[along[:half]], node), (rows[along[half:]], node)]
        placed = np.concatenate(taken)
        self.ids, self.vectors = ids[placed], vectors[placed]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of each query's products in each leaf: the lowest bound on the way to it."""
        norms = np.sqrt((queries**2).sum(axis=1))
        bound = queries @ self.centres.T + norms[:, None] * self.radii[None]
        for node, parent in enumerate(self.parents):
            if parent >= 0:
                np.minimum(bound[:, node], bound[:, parent], out=bound[:, node])
        # The products are whole numbers; a little more covers the rounding of the bounds.
        return bound[:, [n for n, _, _ in self.leaves]] * (1 + 1e-9) + 1e-6

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of each query's k best rows; -1 marks free places.

        ``floors`` are kth scores known from elsewhere; rows below them need not be found.
        """
        count = len(queries)
        bound = self.bounds(queries)
        order = np.argsort(-bound, axis=1, kind="stable")
        best_ids = np.full((count, k), -1, np.int64)
        best = np.full((count, k), np.iinfo(np.int64).min, np.int64)
        active = np.arange(count)
        for step in range(len(self.leaves)):
            leaf = order[active, step]
            kth = np.maximum(best[active, -1], floors[active]).astype(float)
            going = bound[active, leaf] >= kth
            active, leaf = active[going], leaf[going]
            if not len(active):
                break
            for number in np.unique(leaf):
                rows = active[leaf == number]
                _, start, stop = self.leaves[number]
                found = exact_products(queries[rows], self.vectors[start:stop])
                names = np.broadcast_to(self.ids[start:stop], found.shape)
                own = names == query_ids[rows, None]
                found = np.where(own, np.iinfo(np.int64).min, found)
                names = np.where(own, -1, names)
                all_ids = np.concatenate([best_ids[rows], names], axis=1)
                all_scores = np.concatenate([best[rows], found], axis=1)
                pick = np.lexsort((all_ids, -all_scores.astype(np.longdouble)), axis=1)[:, :k]
                best_ids[rows] = np.take_along_axis(all_ids, pick, axis=1)
                best[rows] = np.take_along_axis(all_scores, pick, axis=1)
        return best_ids, best


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers, by floating point where that is exact."""
    most = (np.abs(a).max(initial=0) or 1) * (np.abs(b).max(initial=0) or 1) * a.shape[1]
    if most < 2**53:
        return np.rint(a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return out


def top_k(rows: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest inner products.

    ``rows`` has vec_id and embedding; components x count as floor(scale * x).
    ``is_query`` is a condition on vec_id. A row is never its own query's answer;
    ties go to the smaller vec_id; a query with fewer candidates gets them all.
    Vectors that are NULL or hold NULL or non-finite components, and rows without
    vec_id, take no part. Shorter vectors are filled with zeros. If a vec_id comes
    more than once, its smallest vector counts. Products must fit 64 bits.
    """
    # From 2^53 on a double is whole already.
    whole = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale),
    )
    vectors = stage(
        rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .select("vec_id", whole.alias("vector"))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector")),
        "topk-vectors",
    )
    size = vectors.agg(
        F.count(F.lit(1)), F.count(F.when(is_query(F.col("vec_id")), 1)), F.max(F.size("vector"))
    ).first()
    shards = max(1, -(-size[0] // SHARD_ROWS))
    blocks = max(1, -(-size[1] // BLOCK_QUERIES))
    width = max(size[2] or 0, 1)
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    queries = vectors.where(is_query(F.col("vec_id"))).select(
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
    )

    def search(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        tree = BallTree(candidates["vec_id"].to_numpy(np.int64), _matrix(candidates["vector"].to_list(), width))
        asked_ids = asked["query_id"].to_numpy(np.int64)
        asked_vectors = _matrix(asked["query"].to_list(), width)
        ids, scores = tree.search(asked_ids, asked_vectors, asked["floor"].to_numpy(np.int64), k)
        found = pd.DataFrame({"query_id": np.repeat(asked_ids, k), "vec_id": ids.ravel(), "score": scores.ravel()})
        return found[found["vec_id"] != -1] if (ids == -1).any() else found

    def searched(rows_by_shard: DataFrame, asked: DataFrame) -> DataFrame:
        left = rows_by_shard.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = asked.withColumnsRenamed({"shard": "to_shard", "block": "own_block"})
        return (
            left.groupBy("shard", "block")
            .cogroup(right.groupBy("to_shard", "own_block"))
            .applyInPandas(search, "query_id long, vec_id long, score long")
        )

    lowest = F.lit(-(2**63)).cast("long")
    first = stage(
        searched(dealt.where("shard = 0"), queries.withColumns({"shard": F.lit(0), "floor": lowest})), "topk-first"
    )
    if shards > 1:
        kth = first.groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"),
        )
        others = (
            queries.join(kth, "query_id", "left")
            .withColumn("floor", F.coalesce("kth", lowest))
            .withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
            .drop("kth")
        )
        first = first.unionByName(searched(dealt.where("shard > 0"), others))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        first.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


ship_by_value(__name__)
