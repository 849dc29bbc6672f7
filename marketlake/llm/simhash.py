"""Near-duplicates by SimHash fingerprints, found through the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import free_name, ship, written

WORDS = 3
SEED = 42
#: Differing bits that still link two fingerprints.
THRESHOLD = 2
#: The covering code: on each of bits 0-22 and 23-45 the perfect binary Golay code, whose words are at most RADIUS bits
#: from anything; the other 18 bits are free. Its generator polynomial:
GOLAY = 0b101011100011
LENGTH, CHECKS, RADIUS, BLOCKS = 23, 11, 3, 2
_SHINGLES = 1 << 16


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is set in over half the hashes of a text's shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    total, counts = max(1, len(words) - WORDS + 1), np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _SHINGLES):
        part = words[at : at + _SHINGLES + WORDS - 1]
        n = max(1, len(part) - WORDS + 1)
        hashes = np.array([digest(b" ".join(part[i : i + WORDS]), SEED) for i in range(n)], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprinted(docs: DataFrame, text: str = "text", to: str = "__fingerprint") -> DataFrame:
    """docs with a bigint column `to`: the fingerprint's 64 bits."""
    ship(docs.sparkSession)

    @F.pandas_udf("bigint")
    def bits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            found = np.array([fingerprint(t if isinstance(t, str) else None) for t in series], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return docs.withColumn(to, bits(F.col(text)))


def _syndrome(v: int) -> int:
    """Remainder of v, as a polynomial over two elements, by the generator."""
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if v >> bit & 1:
            v ^= GOLAY << (bit - CHECKS)
    return v


@cache
def coset_words(threshold: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The syndromes of single bits; then for t = 0, 1 ... threshold a table by syndrome of the words that have it and
    that have up to RADIUS bits (t = 0: one word, as the code is perfect) or RADIUS + t bits. Rows are filled up with
    -1. A word with the syndrome of a block is a step from the block to a codeword."""
    single = np.array([_syndrome(1 << b) for b in range(LENGTH)], dtype=np.int64)
    rows: list[list[list[int]]] = [[[] for _ in range(1 << CHECKS)] for _ in range(threshold + 1)]
    for weight in range(RADIUS + threshold + 1):
        for bits in combinations(range(LENGTH), weight):
            s = 0
            for b in bits:
                s ^= int(single[b])
            rows[max(0, weight - RADIUS)][s].append(sum(1 << b for b in bits))
    return single, [np.array([r + [-1] * (max(map(len, level)) - len(r)) for r in level], dtype=np.int64) for level in rows]


def anchors(values: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each fingerprint (uint64) its own anchor, the nearest codeword; then all (number of a fingerprint, anchor)
    that fingerprints are replicated to, their own included.

    A fingerprint within threshold bits of x lies, in each block, within RADIUS + t bits of x's anchor, where the t of
    all blocks add up to threshold at most. So x's own anchor is among the replicas of each of them.
    """
    single, levels = coset_words(threshold)
    shares, base = [], np.zeros(len(values), dtype=np.int64)
    for k in range(BLOCKS):
        block = (values >> np.uint64(LENGTH * k)).astype(np.int64) & ((1 << LENGTH) - 1)
        base |= block << (LENGTH * k)
        syndrome = np.zeros(len(block), dtype=np.int64)
        for bit in range(LENGTH):
            syndrome ^= np.where(block >> bit & 1, single[bit], 0)
        shares.append([level[syndrome] for level in levels])
    numbers, found = [], []
    own = None
    for ts in product(range(threshold + 1), repeat=BLOCKS):
        if sum(ts) > threshold:
            continue
        steps, there = np.zeros((len(values), 1), dtype=np.int64), np.ones((len(values), 1), dtype=bool)
        for k, t in enumerate(ts):
            step = shares[k][t]
            steps = (steps[:, :, None] | (np.maximum(step, 0) << (LENGTH * k))[:, None, :]).reshape(len(values), -1)
            there = (there[:, :, None] & (step >= 0)[:, None, :]).reshape(len(values), -1)
        if own is None:
            own = base ^ steps[:, 0]
        numbers.append(np.nonzero(there)[0])
        found.append((base[:, None] ^ steps)[there])
    return own, np.concatenate(numbers), np.concatenate(found)


def links(fingerprints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs u < v of the distinct fingerprints (column f) that differ in 1 to threshold bits, each once.

    Each is replicated to the anchors around it; at the anchor of the smaller one of a pair the two meet. The join
    keeps only pairs within the threshold, so neither all pairs at an anchor nor copies are ever rows; Spark splits an
    anchor that many fingerprints share (AQE skew join). It is told to sort and merge: it takes replicas to be as few as
    fingerprints and would broadcast them through the driver, some sixty rows for each.
    """
    ship(fingerprints.sparkSession)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                f = pdf["f"].to_numpy(dtype=np.int64)[at : at + 4096]
                own, number, anchor = anchors(f.view(np.uint64), threshold)
                yield pd.DataFrame({"anchor": anchor, "v": f[number], "home": anchor == own[number]})

    # each becomes some sixty rows, so few bytes are dealt out to as many tasks as a large shuffle would get
    spread = fingerprints.select("f").repartition(int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = spread.mapInPandas(deal, "anchor bigint, v bigint, home boolean")
    at_home = dealt.where("home").select("anchor", F.col("v").alias("u"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= threshold
    return at_home.join(dealt.select("anchor", "v").hint("merge"), "anchor").where((F.col("u") < F.col("v")) & near).select("u", "v")


def classes(found: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """f and root for every fingerprint that is linked to a smaller one; found has the column f, repeated or not."""
    return components(links(found.select("f").distinct(), threshold)).select(F.col("node").alias("f"), "root")


def _with_root(rows: DataFrame, threshold: int) -> DataFrame:
    """rows (f, ...) with the root of f's component."""
    roots = classes(rows, threshold).select(F.col("f").alias("__f"), "root")
    return rows.join(roots, F.col("f") == F.col("__f"), "left").withColumn("root", F.coalesce("root", "f")).drop("__f")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of docs (doc_id, text); other columns are
    ignored. component_id is the smallest doc_id that links lead to.

    Fingerprints are computed once and written to the shared folder; equal ones are one node, so copies cost nothing
    more. Null and empty texts have fingerprint zero and link like any other. Null ids take part and are never the
    smallest; a component of null ids has a null component_id. Repeated rows are each returned. Tables of fingerprints are
    small as files and not in memory, so they are joined by sorting and none is broadcast.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = written(fingerprinted(slim).select("doc_id", F.col("__fingerprint").alias("f")), "fingerprints")
    nodes = written(_with_root(prints.groupBy("f").agg(F.min("doc_id").alias("first")), threshold), "nodes")
    ids = nodes.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("component_id"))
    named = nodes.join(ids.hint("merge"), F.col("root") == F.col("r")).select(F.col("f").alias("__f"), "component_id")
    return prints.join(named.hint("merge"), F.col("f") == F.col("__f")).select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """docs with one row of each component of near_duplicates(): that of the smallest doc_id (of rows that repeat this
    id, that of the smallest fingerprint, then the first written). All columns are kept, whatever their names.

    Rows are numbered as they are written with their fingerprints; those to drop are known by number, and texts stay
    where they are while these are few.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    to, row = free_name(docs, "fingerprint"), free_name(docs, "row")
    whole = written(fingerprinted(docs, to=to).withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    slim = whole.select(F.col(to).alias("f"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(to).alias("f"), F.col(row).alias("row")).alias("k"))
    best = _with_root(slim.groupBy("f").agg(F.min("k").alias("k")), threshold).groupBy("root").agg(F.min("k").alias("k"))
    dropped = written(whole.select(row).join(best.select(F.col("k.row").alias(row)), row, "left_anti"), "dropped")
    return whole.join(dropped, row, "left_anti").select(*columns)
