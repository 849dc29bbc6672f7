"""Quality classification: logistic regression on hashed word n-grams, trained with FTRL-proximal updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .language_id import held_out
from .shared import largest, mixed, ship, token_hashes

BITS = 20
REACH = 4
#: Labelled rows that training takes at most.
MAX_TRAIN_ROWS = 6000
#: Features of such a row, those with the largest counts: what the driver gathers is at most 8 bytes of these for each row.
MAX_FEATURES = 4096
#: A document's n-gram counts are scaled to this sum.
SCALE = 32.0


def buckets(tokens: np.ndarray, repeats: bool = True) -> np.ndarray:
    """Hashed numbers of the n-grams in one text: single words, pairs of neighbours, and with repeats, whatever the word,
    the n-grams of up to REACH + 1 words that end as they begin (a text that repeats itself is full of them)."""
    with np.errstate(over="ignore"):
        pairs = tokens[:-1] * np.uint64(0x9E3779B97F4A7C15) + (tokens[1:] ^ np.uint64(0x5851F42D4C957F2D))
    again = [np.full(np.count_nonzero(tokens[lag:] == tokens[:-lag]), lag, dtype=np.uint64) for lag in range(1, REACH + 1) if repeats]
    return (mixed(np.concatenate([tokens, pairs, *again])) >> np.uint64(64 - BITS)).astype(np.int32)


def sparse(tokens: np.ndarray, repeats: bool = True) -> tuple[np.ndarray, np.ndarray]:
    idx, counts = np.unique(buckets(tokens, repeats), return_counts=True)
    return largest(idx, (counts * (SCALE / max(1, counts.sum()))).astype(np.float32), MAX_FEATURES)


class QualityModel:
    def __init__(self, weights: np.ndarray, bias: float, repeats: bool = True):
        self.weights, self.bias, self.repeats = weights, bias, repeats

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 of each text; an empty one has the bias alone."""
        out = np.full(len(texts), self.bias)
        for begin, each in token_hashes(texts, words_only=False):
            for i, tokens in enumerate(each):
                if len(tokens):
                    b = buckets(tokens, self.repeats)
                    out[begin + i] += self.weights[b].sum(dtype=np.float64) * (SCALE / len(b))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 3, alpha: float = 0.15, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, repeats: bool = True) -> QualityModel:
    """FTRL-proximal: per coordinate the sum z of adjusted gradients and n of squared ones; weights follow from both,
    and are zero where |z| stays under l1. The last coordinate is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2))

    ones = sum(r[0] for r in rows)
    if not rows or ones in (0, len(rows)):  # one label only, or none: nothing to separate
        return QualityModel(np.zeros(1 << BITS, dtype=np.float32), float(np.clip(20.0 * ((ones > 0) - 0.5), -10, 10)) if rows else 0.0, repeats)
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for j in rng.permutation(len(rows)):
            y, idx, val = rows[j]
            i, v = np.append(idx, size - 1), np.append(val, 1.0)
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ v, -30, 30))) - y) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(size))
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]), repeats)


def train_quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, repeats: bool = True) -> QualityModel:
    """Learns from the texts of labelled documents: a sample of at most max_rows labels, those with the smallest hash
    of their doc_id. Of rows that repeat an id, one teaches (that of the smallest features); a document with both labels
    teaches nothing, nor do null labels, ids or texts. repeats: whether n-grams that end as they begin are features."""
    ship(docs.sparkSession)
    marks = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("__low"), F.max("quality").alias("__y"))
        .where(F.col("__low") == F.col("__y"))
    )
    total = marks.count()
    if not total:
        return fit_ftrl([], repeats=repeats)
    rank = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 40))
    drawn = marks.withColumn("__rank", rank).where(F.col("__rank") < F.lit(min(1 << 40, int((1 << 40) * (1.1 * max_rows + 40) / total))))
    drawn = drawn.withColumn("__n", F.row_number().over(Window.orderBy("__rank", "doc_id"))).where(F.col("__n") <= max_rows)  # of the drawn rows
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(drawn.select("doc_id", "__y", "__rank")), "doc_id")  # max_rows rows

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for begin, each in token_hashes(pdf["text"].tolist(), words_only=False):
                for i, tokens in enumerate(each):
                    idx, val = sparse(tokens, repeats)
                    out.append((int(pdf["__rank"].iat[begin + i]), int(pdf["__y"].iat[begin + i]), idx.tobytes(), val.tobytes()))
            yield pd.DataFrame(out, columns=["rank", "y", "idx", "val"])

    found = rows.mapInPandas(vectors, "rank bigint, y int, idx binary, val binary").groupBy("rank").agg(F.min(F.struct("idx", "val", "y")).alias("x"))
    told = sorted((r["rank"], r["y"], bytes(r["idx"]), bytes(r["val"])) for r in found.select("rank", "x.*").collect())  # max_rows rows
    return fit_ftrl([(y, np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for _, y, i, v in told], repeats=repeats)


def scored(docs: DataFrame, model: QualityModel, text: str = "text", to: str = "__quality") -> DataFrame:
    """docs with a double column `to`: the sparse dot product of weights and n-grams, as a probability."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB of weights, whatever the input

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series(sent.value.scores([t if isinstance(t, str) else None for t in series]))

    return docs.withColumn(to, score(F.col(text)))


def classify_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, repeats: bool = True) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (doc_id, text); other columns are ignored.

    A third of the documents, those whose crc32(doc_id) mod 3 is 1, is held out of training. Null and empty texts are
    scored with the bias. Repeated rows are each scored; a null doc_id is not held out. Without usable labels every
    score is 0.5.
    """
    model = train_quality_model(docs.select("doc_id", "text"), labels.where(~held_out(1, 3)).select("doc_id", "quality"), max_rows, repeats)
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(1, 3).alias("held_out"), F.col("__quality").alias("score"), (F.col("__quality") >= 0.5).cast("int").alias("predicted"))
