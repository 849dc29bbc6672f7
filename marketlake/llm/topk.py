"""Exact top-k search by inner product: a KD-tree per shard, searched best box first."""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ship, written

#: Vectors in a shard and queries in a block (on average), vectors in a leaf, queries whose bounds are made at a time.
SHARD_ROWS, BLOCK_ROWS, LEAF, CHUNK = 8192, 32768, 64, 512
SCALE = 256
TOP = (1 << 63) - 1
#: Scores that doubles can hold; as the least score to reach, a smaller number is as right.
LARGE = 10**300


class Tree:
    """A KD-tree: median splits along the widest side, with the tight bounding box of each node's vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.low, self.high, self.children, self.span = [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            here = len(self.low)
            own = vectors[order[a:b]]
            low, high = own.min(axis=0), own.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.children.append([-1, -1])
            self.span.append((a, b))
            if parent >= 0:
                self.children[parent][side] = here
            axis = int(np.argmax(high - low)) if len(low) else 0
            if b - a > leaf and len(low) and high[axis] > low[axis]:
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
                todo += [(a, a + mid, here, 0), (a + mid, b, here, 1)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.ids, self.rows, self.vectors = ids[order], rows[order], vectors[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, the largest inner product that a vector in the node's box can have."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, own_row: int, query: np.ndarray, bounds: np.ndarray, k: int, least: float) -> list[tuple[int, int]]:
        """Up to k (-score, id) of score `least` or more, best first, smaller ids first among equals; boxes are opened
        best bound first, until the next one cannot reach the k-th score so far. The query's own row is left out."""
        best: list[tuple[int, int]] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            left, right = self.children[node]
            if left >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            a, b = self.span[node]
            scores = self.vectors[a:b] @ query
            for i in np.flatnonzero(scores >= least):
                if self.rows[a + i] != own_row:
                    best.append((-int(scores[i]), int(self.ids[a + i])))
            if len(best) >= k:
                best = heapq.nsmallest(k, best)
                least = max(least, -best[-1][0])
        return sorted(best)[:k]


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component of finite doubles: as doubles while those are exact, else as Python's integers."""
    if not vectors.size or np.abs(vectors).max() < 2.0**43:
        return np.floor(vectors * SCALE)
    whole = [[int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in v] for v in vectors.tolist()]
    return np.array(whole, dtype=object).reshape(vectors.shape)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """Arrays of whole numbers in a type whose products cannot overflow: doubles while those are exact, else Python's
    integers."""
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    width = max((a.shape[1] for a in arrays if a.ndim == 2), default=1)
    if top * top * max(1, width) < 1 << 52:
        return [a.astype(np.float64) for a in arrays]
    return [np.array([int(x) for x in a.flat], dtype=object).reshape(a.shape) for a in arrays]


def usable(embedding: Column) -> Column:
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _stacked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pdf = pdf.sort_values(["vec_id", "row"])
    vectors = np.stack(pdf["e"].to_numpy()).astype(np.float64) if len(pdf) else np.empty((0, 0))
    return pdf["vec_id"].to_numpy(dtype=np.int64), pdf["row"].to_numpy(dtype=np.int64), quantised(vectors)


def _found(tree: Tree, rows: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """The number of each query with what search() finds in a tree; bounds are made for CHUNK queries at a time."""
    tree.vectors, tree.low, tree.high, queries = exact(tree.vectors, tree.low, tree.high, queries)
    for at in range(0, len(rows), CHUNK):
        bounds = tree.bounds(queries[at : at + CHUNK])
        for i, b in enumerate(bounds, at):
            yield i, tree.search(int(rows[i]), queries[i], b, k, float(least[i]))


def _with_least(asked: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """asked with `least`: the k-th score of each query in the first shard, or less; NULL where that has fewer rows."""
    first = {r["dim"]: bytes(r["tree"]) for r in trees.where("shard = 0").select("dim", "tree").collect()}  # one shard's vectors
    sent = asked.sparkSession.sparkContext.broadcast(first)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                least = np.full(len(part), np.nan)
                part = part.sort_values(["vec_id", "row"])
                if dim in sent.value:
                    _, rows, queries = _stacked(part)
                    for i, best in _found(pickle.loads(sent.value[dim]), rows, queries, np.full(len(part), -np.inf), k):
                        if len(best) == k:
                            kth = -best[-1][0]
                            least[i] = -np.inf if kth < -LARGE else np.nextafter(float(min(kth, LARGE)), -np.inf)
                yield part.assign(least=least)

    return asked.mapInPandas(search, "vec_id bigint, row bigint, dim int, e array<double>, least double")


def _halves(score: int) -> tuple[int, int]:
    """A score as two longs that order as it does, up to 126 bits; beyond, those of the end of that range."""
    score = min(max(score, -1 << 126), (1 << 126) - 1)
    return score >> 63, score & TOP


def _searched(trees: DataFrame, block: pd.DataFrame, k: int) -> DataFrame:
    """query, query_id, vec_id and score (its high and low bits) of each query's best k in each tree. The block of
    queries is sent to the trees."""
    block = block.sort_values(["vec_id", "row"])
    queries = {int(dim): (*_stacked(part), np.nan_to_num(part["least"].to_numpy(), nan=-np.inf)) for dim, part in block.groupby("dim")}
    sent = trees.sparkSession.sparkContext.broadcast(queries)  # BLOCK_ROWS vectors

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, packed in zip(pdf["dim"], pdf["tree"]):
                if dim not in sent.value:
                    continue
                ids, rows, all_q, least = sent.value[dim]
                out = [(rows[i], ids[i], v, *_halves(-s)) for i, best in _found(pickle.loads(packed), rows, all_q, least, k) for s, v in best]
                yield pd.DataFrame(out, columns=["query", "query_id", "vec_id", "high", "low"]).astype("int64")

    return trees.select("dim", "tree").mapInPandas(search, "query bigint, query_id bigint, vec_id bigint, high bigint, low bigint")


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each row whose vec_id is divisible by `every` the k other rows with the largest integer inner product.

    vectors has vec_id and embedding; other columns are ignored. Returns query_id, rank (from 1), vec_id and score,
    ties to the smaller vec_id. Rows are dealt into shards by number, so copies of a row are spread too; each shard is
    made into a KD-tree once and written, and vectors are never shuffled again. All queries first search the first
    shard; the k-th scores found there go with them to all trees, where boxes that cannot reach them stay closed.
    Queries go to the trees in blocks of about block_rows, which bounds what is broadcast and what the driver holds. A
    task holds one tree and one block.

    Defined cases: vectors that are null or have null or non-finite components take no part, nor do those without
    vec_id; any finite component does, with whole numbers of any size. Only vectors of the same length are compared.
    Rows that repeat a vec_id are candidates each, also for each other, and queries each. Fewer rows than k give all
    there are. A score beyond 64 bits is shown as the end of their range; ranks follow the true score up to 126 bits
    and the vec_id beyond.
    """
    spark = vectors.sparkSession
    ship(spark)
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where(F.col("vec_id").isNotNull() & usable(F.col("e")))
    slim = written(slim.select("vec_id", "e", F.size("e").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    n_shards = max(1, -(-slim.count() // shard_rows))

    def number(of: int, salt: str) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(of)).cast("int")

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], pickle.dumps(Tree(*_stacked(pdf))))], columns=["dim", "shard", "tree"])

    trees = written(slim.withColumn("shard", number(n_shards, "shard")).groupBy("dim", "shard").applyInPandas(grow, "dim int, shard int, tree binary"), "trees")
    asked = slim.where(F.col("vec_id") % every == 0).select("vec_id", "row", "dim", "e")
    n_blocks = max(1, -(-asked.count() // block_rows))
    asked = written(_with_least(asked, trees, k).withColumn("block", number(n_blocks, "block")), "queries")

    ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("high"), F.desc("low"), "vec_id"))
    score = F.when(F.col("high") == 0, F.col("low")).when(F.col("high") == -1, F.col("low") + F.lit(-TOP - 1)).otherwise(F.when(F.col("high") > 0, F.lit(TOP)).otherwise(F.lit(-TOP - 1)))
    out = None
    for b in range(n_blocks):
        found = _searched(trees, asked.where(F.col("block") == b).toPandas(), k)
        best = found.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
        out = best if out is None else out.union(best)
    return out
