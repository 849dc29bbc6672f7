"""Near copies by the Jaccard similarity of word shingles: SimHash anchors bring texts together, exact sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import drop_written, free_name, grams, mixed, ship, small_batches, written
from .simhash import BLOCKS, LENGTH, anchors

#: Words of a shingle, and the share of their joint shingles that two near copies have in common.
WORDS, SIMILARITY = 5, 0.8
#: Fingerprints of a text's words, and the differing bits at which two of them surely meet at an anchor.
PRINTS, THRESHOLD = 8, 1
#: Longs of the parities of a set of shingles: a bit for each of 512 classes of hashes, set if the class has an odd number.
PARITIES = 8
#: One of so many shingles is looked at beyond those that must hold a shared one; so many more of them must be shared.
MORE = 20
#: So many shared shingles that come just before one are kept with it, to tell whether two sets have met before it.
BEFORE = 4
_SEEDS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64) for k in range(PRINTS)], dtype=np.uint64)
_SLACK = 1e-6  # of products of a size and a similarity, so that rounding never excludes a pair


def _words(text: str | None) -> np.ndarray:
    """Hashes of the words, which are what white space parts, lower-cased in ASCII."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes (uint64, sorted) of all runs of words; a shorter text is one run."""
    return _shingles(_words(text), words)


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    return np.unique(grams(hashes, min(words, len(hashes)))) if len(hashes) else np.empty(0, dtype=np.uint64)


def fingerprints(features: np.ndarray, n: int = PRINTS) -> np.ndarray:
    """n independent SimHash fingerprints (uint64) of a set of hashes: a bit is set if over half of them have it."""
    counts = np.zeros(64 * n, dtype=np.int64)
    for at in range(0, len(features), 255):  # so many votes fit a byte
        with np.errstate(over="ignore"):
            each = mixed(features[at : at + 255, None] ^ _SEEDS[:n])
        counts += np.add.reduce(np.unpackbits(each.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(features), bitorder="little").view(np.uint64)


def parities(features: np.ndarray) -> np.ndarray:
    """PARITIES longs (uint64) of a set of hashes. Those of two sets differ in no more bits than the sets in elements."""
    odd = np.bincount((features & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def needed(n: int, similarity: float = SIMILARITY) -> int:
    """How many of its n shingles a set has in common with any similar one, at least."""
    return ceil(n * similarity - _SLACK)


def _needed(n: Column, similarity: float) -> Column:
    return F.ceil(n * similarity - _SLACK)


def _sketched(docs: DataFrame, words: int, similarity: float, to: str) -> DataFrame:
    """docs with a struct column: node (a hash of the set of shingles), n (its size), anchored (fingerprints of the set
    of words), compared (parities of the set of shingles) and first (its smallest shingles: as many as may be missing in
    a similar set, one, and 1 in MORE); texts without words have none."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    @F.pandas_udf("node bigint, n int, anchored array<bigint>, compared array<bigint>, first array<bigint>")
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            nodes, sizes, anchored, compared, first = [], [], [], [], []
            for text in series:
                hashes = _words(text if isinstance(text, str) else None)
                own = _shingles(hashes, words)
                nodes.append(xxhash.xxh64_intdigest(own.tobytes(), 42))
                sizes.append(len(own))
                anchored.append(fingerprints(np.unique(hashes)).view(np.int64) if len(own) else [])
                compared.append(parities(own).view(np.int64))
                first.append(own[: len(own) - needed(len(own), similarity) + 1 + len(own) // MORE].view(np.int64))
            yield pd.DataFrame({"node": np.array(nodes, dtype=np.uint64).view(np.int64), "n": sizes, "anchored": anchored, "compared": compared, "first": first})

    return docs.withColumn(to, sketch("text"))


def _in_play(nodes: DataFrame, similarity: float) -> DataFrame:
    """node, n, anchored and compared of the nodes that may have a similar one; all others surely have none.

    Let two similar sets of n and m shingles have c in common, so c >= needed(n), needed(m). The k smallest of these are
    among the n - c + k smallest of the one and the m - c + k smallest of the other. With k = 1 + min(n, m) // MORE they
    are in `first` of both, and k >= 1 + needed(n) // MORE. So a node that shares fewer of `first` is out. Shared
    shingles are counted before nodes are joined to them; a shingle of very many nodes is split by Spark (AQE skew join).
    """
    each = nodes.select("node", F.explode("first").alias("s"))
    shared = written(each.groupBy("s").agg(F.count("*").alias("c")).where("c > 1").select("s"), "common")
    hits = each.join(shared, "s", "left_semi").groupBy("node").agg(F.count("*").alias("hits"))
    found = nodes.join(hits, "node").where(F.col("hits") >= 1 + F.floor(_needed(F.col("n"), similarity) / MORE))
    out = written(found.select("node", "n", "anchored", "compared"), "play")
    _drop(shared)
    return out


def _dealt(nodes: DataFrame, home_only: bool) -> DataFrame:
    """cell, node, root and home of nodes (node, root, anchored): each fingerprint of the words at its own anchor (home)
    and, unless home_only, at all others within covering radius plus THRESHOLD. Of nodes with one root, a cell gets from
    a batch one at home and one that is not."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 2048):
                part = pdf.iloc[at : at + 2048]
                prints = np.stack(part["anchored"].to_numpy()).astype(np.int64).view(np.uint64)
                node, root = part["node"].to_numpy(np.int64), part["root"].to_numpy(np.int64)
                for k in range(PRINTS):
                    own, number, anchor = anchors(prints[:, k], 0 if home_only else THRESHOLD)
                    out = pd.DataFrame({"cell": anchor | k << (LENGTH * BLOCKS), "node": node[number], "root": root[number], "home": anchor == own[number]})
                    yield out if home_only else out.drop_duplicates(["cell", "root", "home"])

    # each becomes some 80 rows, so few bytes are dealt out to as many tasks as a large shuffle would get
    spread = nodes.select("node", "root", "anchored").where(F.size("anchored") > 0)
    spread = spread.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInPandas(deal, "cell bigint, node bigint, root bigint, home boolean")


def _sets(members: DataFrame, texts: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """node and s (the set of shingles) of the members (node). texts has row and text, rows the row of each node; texts
    stay where they are while members are few."""

    @F.pandas_udf("array<bigint>")
    def sets(each: pd.Series) -> pd.Series:
        return pd.Series([shingles(t if isinstance(t, str) else None, words).view(np.int64) for t in each])

    wanted = written(members.join(rows, "node"), "wanted")
    out = written(texts.join(wanted, "row").select("node", sets("text").alias("s")), "shingles")
    drop_written(wanted)
    return out


def _similar(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets of shingles, in known, have at least this similarity."""
    of = lambda name: known.select(F.col("node").alias(name), F.col("s").alias(f"s{name}"))
    both = pairs.join(of("u"), "u").join(of("v"), "v")
    shared = F.size(F.array_intersect("su", "sv"))
    return written(both.where(shared / (F.size("su") + F.size("sv") - shared) >= similarity).select("u", "v"), "similar")


def _drop(*tables: DataFrame) -> None:
    """Deletes tables that nothing reads any more, so that no step's tables stay on disk beside the next one's."""
    for t in tables:
        drop_written(t)


def _near(x: Column, y: Column, similarity: float) -> Column:
    """Whether the sets of nodes (node, n, compared) may be similar: nothing that is gets lost, as similar sets differ in
    (1 - similarity) / (1 + similarity) of the sum of their sizes at most, and in no fewer elements than parities."""
    bits = reduce(lambda a, b: a + b, (F.bit_count(F.get(x["compared"], F.lit(k)).bitwiseXOR(F.get(y["compared"], F.lit(k)))) for k in range(PARITIES)))
    n, m = x["n"], y["n"]
    return (F.least(n, m) >= F.greatest(n, m) * similarity - _SLACK) & (bits <= (n + m) * ((1 - similarity) / (1 + similarity)) + _SLACK)


def _rooted(nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """nodes with the root of their component, themselves if nothing links them."""
    return nodes.join(components(linked), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _pair(u: Column, v: Column) -> list[Column]:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def groups(nodes: DataFrame, texts: DataFrame, rows: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """node and root of each node that is linked to a smaller one; nodes has node, n, anchored, compared and first, one
    row a node. All links between similar nodes of different components are found.

    Only nodes that may have a similar one take part. Those that meet at anchors are linked first: each node is held
    against one other at its home anchors; then, of each component at an anchor, one member at home against one of every
    other. What fingerprints do not bring together (much added text) is found from the rarest shingles. Members of one
    component are not held against each other again, so a group of very many near copies costs little. A table that
    nodes is read from goes.
    """
    every, nodes = nodes, _in_play(nodes, similarity)
    _drop(every)
    known = _sets(nodes.select("node"), texts, rows, words)
    tested = _home_pairs(nodes)
    likely = _likely(tested, nodes, similarity)
    linked = _similar(likely, known, similarity)
    _drop(likely)

    rooted = written(_rooted(nodes, linked), "rooted")
    met = _anchor_pairs(rooted, similarity)
    fresh = written(met.join(tested, ["u", "v"], "left_anti"), "pairs")
    linked = linked.union(_similar(fresh, known, similarity))
    _drop(rooted, met)

    rooted = written(_rooted(nodes, linked), "rooted")
    met = _rare_pairs(rooted, known, similarity)
    rest = written(met.join(tested.union(fresh), ["u", "v"], "left_anti"), "pairs")
    linked = linked.union(_similar(rest, known, similarity))
    _drop(rooted, met, tested, fresh, rest, known, nodes)
    return components(linked)


def _home_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (u, v) of each node and a centre of each of its home anchors."""
    homes = written(_dealt(nodes.withColumn("root", F.col("node")), home_only=True).select("cell", "node"), "homes")
    # a centre of its own for each cell, so that members of one group meet several
    order = F.struct(F.xxhash64("cell", "node").alias("o"), "node")
    centres = homes.groupBy("cell").agg(F.min(order).alias("c"), F.max(order).alias("m")).where("c != m").select("cell", F.col("c.node").alias("centre"))
    stars = homes.join(centres, "cell").where(F.col("node") != F.col("centre"))
    out = written(stars.select(*_pair(F.col("node"), F.col("centre"))).distinct(), "pairs")
    _drop(homes)
    return out


def _anchor_pairs(nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) that may be similar, of different components, where one is at the home anchor of the other; of each
    component an anchor has one node at home and one at all."""
    dealt = written(_dealt(nodes, home_only=False), "dealt")
    cells = dealt.groupBy("cell").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.max("home").alias("h")).where("a != b AND h").select("cell")
    met = dealt.join(cells, "cell", "left_semi").groupBy("cell", "root").agg(F.min("node").alias("any"), F.min(F.when(F.col("home"), F.col("node"))).alias("own"))
    met = written(met, "met")
    _drop(dealt)
    of = lambda node, name: nodes.select(F.col("node").alias(node), F.struct("node", "n", "compared").alias(name))
    here = met.where("own is not null").select("cell", F.col("root").alias("rx"), "own").join(of("own", "x"), "own")
    there = met.select("cell", F.col("root").alias("ry"), "any").join(of("any", "y"), "any")
    both = here.join(there, "cell").where((F.col("rx") != F.col("ry")) & _near(F.col("x"), F.col("y"), similarity))
    out = written(both.select(*_pair(F.col("x.node"), F.col("y.node"))).distinct(), "near")
    _drop(met)
    return out


def _rare_pairs(nodes: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """All pairs (u, v) of nodes of different components that may be similar: they share one of the rarest shingles of both.

    In any order of shingles that is the same for all sets, similar ones share one of their n - needed(n) + 1 first. Here
    those that only one component has come first, then the others, the rarest first: so of a node with more than
    n - needed(n) shingles of its component's own, nothing is left, and passages of many texts come last.
    """
    heads = _heads(nodes, known, similarity)
    out = written(_sharing(heads, similarity).select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct(), "near")
    _drop(heads)
    return out


def _heads(nodes: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """s, root and x of each node's rarest shingles; x is the node with left, how many shared shingles come after s, and
    before, the last BEFORE of those before it."""
    each = known.join(nodes.select("node", "root"), "node").select("node", "root", F.explode("s").alias("s"))
    common = each.groupBy("s").agg(F.count("*").alias("c"), F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("s", "c")
    common = written(common, "common")
    own = Window.partitionBy("node")
    heads = each.join(common, "s").withColumns({
        "rank": F.row_number().over(own.orderBy("c", "s")), "total": F.count("*").over(own),
        "before": F.collect_list("s").over(own.orderBy("c", "s").rowsBetween(-BEFORE, -1)),
    })
    heads = heads.join(nodes.select("node", "n", "compared"), "node").where(F.col("rank") <= F.col("total") - _needed(F.col("n"), similarity) + 1)
    heads = heads.withColumn("left", F.col("total") - F.col("rank"))
    heads = written(heads.select("s", "root", F.struct("node", "n", "compared", "left", "before").alias("x")), "heads")
    _drop(common)
    return heads


def _sharing(heads: DataFrame, similarity: float) -> DataFrame:
    """x and y for each shingle that heads of different components share and that may be the first which two similar nodes
    share: none of those just before it is shared, and all others that are come after it, so both have enough left. The
    first one of a pair of similar nodes surely is among them, so no pair is lost; hardly any other row is made of it."""
    others = heads.select("s", F.col("root").alias("ry"), F.col("x").alias("y"))
    x, y = F.col("x"), F.col("y")
    enough = 1 + F.least(x["left"], y["left"]) >= (x["n"] + y["n"]) * (similarity / (1 + similarity)) - _SLACK
    both = heads.join(others, "s").where((F.col("root") != F.col("ry")) & (x["node"] < y["node"]) & enough & ~F.arrays_overlap(x["before"], y["before"]) & _near(x, y, similarity))
    return both.select("x", "y")


def _likely(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sizes and parities do not rule out that they are similar."""
    of = lambda name: nodes.select(F.col("node").alias(name), F.struct("node", "n", "compared").alias(f"of_{name}"))
    both = pairs.join(of("u"), "u").join(of("v"), "v")
    return written(both.where(_near(F.col("of_u"), F.col("of_v"), similarity)).select("u", "v"), "likely")


def drop_near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each group of near copies: that of the smallest doc_id (of rows that repeat this id, the
    first written; null ids come last). All columns are kept, whatever their names.

    Groups are connected components. Texts with the same set of shingles are one node, so copies cost nothing more; null
    texts and those without words are one such set. Texts are read again only for the pairs that are held against each
    other, and never shuffled whole: rows to drop are known by number. An empty table gives an empty one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row, sketch = free_name(docs, "row"), free_name(docs, "sketch")
    whole = written(_sketched(docs, words, similarity, sketch).withColumn(row, F.monotonically_increasing_id()), "sketched")
    k = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    slim = whole.select(F.col(f"{sketch}.*"), k.alias("k"))
    sketches = [F.first(c).alias(c) for c in ("n", "anchored", "compared", "first")]
    sketched = written(slim.groupBy("node").agg(F.min("k").alias("k"), *sketches), "nodes")
    nodes = written(sketched.select("node", "k"), "keys")
    texts, rows = whole.select(F.col(row).alias("row"), "text"), nodes.select("node", F.col("k.row").alias("row"))
    roots = written(groups(sketched.drop("k"), texts, rows, words, similarity).select(F.col("node").alias("_n"), "root"), "roots")
    best = nodes.join(roots, F.col("node") == F.col("_n"), "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("k").alias("k"))
    kept = best.select(F.col("k.row").alias(row))
    drop = written(whole.select(row).join(kept, row, "left_anti"), "dropped")
    _drop(nodes, roots)
    return whole.join(drop, row, "left_anti").select(*columns)
