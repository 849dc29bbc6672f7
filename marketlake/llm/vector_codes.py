"""Compressing vectors to codes: codebooks by integer k-means, nearest entries by a GNAT over each codebook."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, written
from .topk import usable

#: Whole numbers for one in a component; parts of a vector; entries of a codebook; rounds of training.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Split points of a node of a tree, and entries up to which there is no node.
SPLITS, LEAF = 4, 3
#: Bits of the numbers that sums are sent in: a sum of large components is several.
LIMB = 40
TOP = (1 << 63) - 1


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE x) of finite doubles: as int64 while squared distances fit, else as Python's integers."""
    if not vectors.size or np.abs(vectors).max() < 2.0**14:
        return np.floor(vectors * SCALE).astype(np.int64)
    exact = [[int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in v] for v in vectors.tolist()]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def bounds(n: int) -> list[tuple[int, int]]:
    """Where the parts of a vector of n components are: equal ones, if PARTS divides n."""
    return [(i * n // PARTS, (i + 1) * n // PARTS) for i in range(PARTS)]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to y, exact."""
    d = x - y
    return (d * d).sum(axis=1) if d.shape[1] else np.zeros(len(d), x.dtype)


def root(square: np.ndarray, up: bool) -> np.ndarray:
    """A whole number that is no larger (up: no smaller) than the square root."""
    if square.dtype == object:
        return np.array([math.isqrt(v) + up for v in square], dtype=object)
    near = np.floor(np.sqrt(square.astype(np.float64))).astype(np.int64)
    return near + 2 if up else np.maximum(near - 1, 0)


@dataclass
class Node:
    """Split points (numbers of entries) with the entries of their subtrees, and for each pair of a split point and a
    subtree how far the subtree's entries are from the split point, rounded outwards."""

    splits: list[int]
    below: list[Node | list[int]]
    nearest: list[list[int]]
    farthest: list[list[int]]


def gnat(entries: np.ndarray, numbers: list[int]) -> Node | list[int]:
    """A geometric near-neighbour access tree over some entries: split points far apart, each other entry below the
    nearest of them. A few entries, or equal ones, are a list."""
    if len(numbers) <= LEAF or all((entries[i] == entries[numbers[0]]).all() for i in numbers):
        return list(numbers)
    splits, far = [numbers[0]], squared(entries[numbers], entries[numbers[0]])
    while len(splits) < SPLITS and far.max() > 0:
        splits.append(numbers[int(np.argmax(far))])
        far = np.minimum(far, squared(entries[numbers], entries[splits[-1]]))
    away = np.stack([squared(entries[numbers], entries[s]) for s in splits])
    group = [[] for _ in splits]
    for k, (i, best) in enumerate(zip(numbers, np.argmin(away, axis=0).tolist())):
        if i not in splits:
            group[best].append(k)
    own = [[*g, numbers.index(s)] for g, s in zip(group, splits)]
    nearest = [[int(root(away[s, own[j]].min(keepdims=True), up=False)[0]) for j in range(len(splits))] for s in range(len(splits))]
    farthest = [[int(root(away[s, own[j]].max(keepdims=True), up=True)[0]) for j in range(len(splits))] for s in range(len(splits))]
    return Node(splits, [gnat(entries, [numbers[k] for k in g]) if g else [] for g in group], nearest, farthest)


def assigned(x: np.ndarray, entries: np.ndarray, tree: Node | list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the number of its nearest entry, the smallest of equals, and the squared distance.

    The tree is searched for all rows together. A subtree is left out for a row only if it is strictly out of reach: the
    distance to a split point, less or more than the best one so far, is outside the subtree's range there. Distances are
    rounded so that this never leaves out an equal one, and squared whole numbers decide.
    """
    best = np.full(len(x), len(entries), dtype=np.int64)
    least = np.zeros(len(x), dtype=x.dtype)

    def seen(rows: np.ndarray, i: int) -> np.ndarray:
        found = squared(x[rows], entries[i])
        better = (best[rows] == len(entries)) | (found < least[rows]) | ((found == least[rows]) & (i < best[rows]))
        at = rows[np.asarray(better, dtype=bool)]
        best[at], least[at] = i, found[np.asarray(better, dtype=bool)]
        return found

    def search(node: Node | list[int], rows: np.ndarray) -> None:
        if isinstance(node, list):
            for i in node:
                seen(rows, i)
            return
        open_ = np.ones((len(node.splits), len(rows)), dtype=bool)
        for s, split in enumerate(node.splits):
            here = np.flatnonzero(open_[s])
            if not len(here):
                continue
            away = seen(rows[here], split)
            low, high, reach = root(away, up=False), root(away, up=True), root(least[rows[here]], up=True)
            for j in range(len(node.splits)):
                out = (low - reach > node.farthest[s][j]) | (high + reach < node.nearest[s][j])
                open_[j, here[np.asarray(out, dtype=bool)]] = False
        for j, below in enumerate(node.below):
            if below and open_[j].any():
                search(below, rows[open_[j]])

    search(tree, np.arange(len(x)))
    return best, least


def together(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x and entries in one type in which squared distances are exact: int64 if they fit."""
    if x.dtype != object and entries.dtype != object:
        top = max(int(np.abs(a).max()) if a.size else 0 for a in (x, entries))
        if 4 * top * top * max(1, x.shape[1]) < 1 << 52:
            return x, entries
    return x.astype(object), entries.astype(object)


class Codebooks:
    """The entries of each part, with a tree over them."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries, self.trees = entries, [gnat(together(e, e)[0], list(range(len(e)))) for e in entries]

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry for each row of x and part, and the squared distances of a row in all."""
        codes, error = np.empty((len(x), PARTS), np.int64), np.zeros(len(x), np.int64)
        for p, (a, b) in enumerate(bounds(x.shape[1])):
            own, entries = together(x[:, a:b], self.entries[p])
            codes[:, p], found = assigned(own, entries, self.trees[p])
            error = error + found
        return codes, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for e in self.entries for row in e for v in row).encode()).hexdigest()


def _narrow(values: list[list[int]], width: int) -> np.ndarray:
    """Whole numbers as int64 if they fit, else as Python's integers."""
    large = any(abs(v) >= 1 << 62 for row in values for v in row)
    return np.array(values, dtype=object if large else np.int64).reshape(len(values), width)


def _sums(vectors: DataFrame, books: Codebooks, n: int) -> dict[tuple[int, int], list[int]]:
    """Sums of the components and, last, the number of the parts that are nearest to each (part, entry). Tasks sum what
    they read, Spark adds that up, and the driver gets a few numbers for each component of a codebook."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int, int], int] = {}
        for pdf in batches:
            x = _stacked(pdf, n)
            codes, _ = sent.value.code(x)
            for p, (a, b) in enumerate(bounds(n)):
                for e in np.unique(codes[:, p]).tolist():
                    own = x[codes[:, p] == e, a:b]
                    for c, v in enumerate([*own.sum(axis=0).tolist(), len(own)]):
                        total[p, e, c] = total.get((p, e, c), 0) + int(v)
        rows = []
        for (p, e, c), v in total.items():
            limb = 0
            while v not in (0, -1) or limb == 0:
                rows.append((p, e, c, limb, v & ((1 << LIMB) - 1)))
                v, limb = v >> LIMB, limb + 1
            rows.append((p, e, c, limb, v))  # the sign
        yield pd.DataFrame(rows, columns=["part", "entry", "at", "limb", "v"])

    each = vectors.select("e").mapInPandas(add, "part int, entry int, at int, limb int, v bigint")
    out: dict[tuple[int, int], list[int]] = {}
    for r in each.groupBy("part", "entry", "at", "limb").agg(F.sum("v").alias("v")).collect():  # 8 * 16 * (n / 8 + 1) * up to 5
        a, b = bounds(n)[r.part]
        out.setdefault((r.part, r.entry), [0] * (b - a + 1))[r["at"]] += r.v << (LIMB * r.limb)
    sent.unpersist()
    return out


def _stacked(pdf: pd.DataFrame, n: int) -> np.ndarray:
    return whole_numbers(np.stack(pdf["e"].to_numpy()).astype(np.float64).reshape(len(pdf), n) if len(pdf) else np.empty((0, n)))


def train(vectors: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of vectors (e), from those of the first rows on."""
    n = first.shape[1]
    books = Codebooks([first[:, a:b] for a, b in bounds(n)])
    for _ in range(rounds):
        found, entries = _sums(vectors, books, n), []
        for p, own in enumerate(books.entries):
            rows = own.tolist()
            for i in range(len(rows)):
                if (p, i) in found:
                    *sums, count = found[p, i]
                    rows[i] = [s // count for s in sums]
            entries.append(_narrow(rows, own.shape[1]))
        books = Codebooks(entries)
    return books


def compress(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every vector (vec_id, embedding, label).

    Components are whole numbers, floor(SCALE x). Vectors are cut into PARTS; each part has a codebook, which begins with
    the vectors of the ENTRIES smallest ids and is trained for ROUNDS: every part goes to its nearest entry and entries
    become means, rounded down. Nearest entries are found by a GNAT over each codebook (assigned()), for all rows of a
    batch together. A round scans the vectors once, and only sums leave a task.

    Defined cases: vectors that are null or hold null or non-finite components take no part, nor do those whose length
    is not that of the smallest id's; a length that PARTS does not divide gives parts that differ by one. Components of
    any finite size are exact; an error, or a sum of errors, that does not fit a long is null. Rows that repeat a vec_id
    are vectors of their own, and the smallest of them by its components is that id's in the first codebook; a null id
    comes last. With fewer than ENTRIES ids codebooks are smaller. Other columns are ignored; no vectors give no rows.
    """
    spark = embeddings.sparkSession
    ship(spark)
    label = F.col("label") if "label" in embeddings.columns else F.lit(None).cast("int").alias("label")
    kept = embeddings.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), label)
    start = kept.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("e").alias("e")).orderBy("vec_id").limit(ENTRIES).collect()
    start = start or kept.orderBy("e").limit(1).collect()
    schema = f"vec_id bigint, label {dict(kept.dtypes)['label']}, code string, error bigint"
    if not start:
        return spark.createDataFrame([], f"{schema}, label_error bigint, codebooks_sha256 string")
    n = len(start[0].e)
    first = whole_numbers(np.array([r.e for r in start if len(r.e) == n], dtype=np.float64).reshape(-1, n))
    vectors = kept.where(F.size("e") == n)
    books = train(vectors, first)
    sent = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes, error = sent.value.code(_stacked(pdf, n))
            total = error.tolist()
            shown = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "label": pdf["label"], "code": shown, "error": pd.array([t if t <= TOP else None for t in total], dtype="Int64")})

    labels = dict(kept.dtypes)["label"]
    coded = written(vectors.withColumn("label", F.col("label").cast("string")).mapInPandas(code, "vec_id bigint, label string, code string, error bigint"), "codes")
    wide = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.when(F.count("*") == F.count("error"), wide).alias("s"))
    sums = sums.select("_label", F.when(F.col("s") <= TOP, F.col("s")).cast("long").alias("label_error"))
    both = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return both.select("vec_id", F.col("label").cast(labels).alias("label"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
