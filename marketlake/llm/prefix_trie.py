"""The prefix trie of conversations, made by truncation peeling: from the deepest turns up, without building a trie first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ship, written

#: Conversations whose ids share all but the last two digits share turns; a conversation takes fewer than HEADS of them.
FAMILY, HEADS = 100, 6
#: Depths in a block: a longer conversation is several rows, and blocks are peeled one after the other.
BLOCK = 512
#: Turns below a prefix up to which one task peels all of them. Prefixes with more are peeled a depth at a time by Spark.
GROUP_TURNS = 4096
#: Consecutive ids, as a power of two, whose decimals are joined before the digest of all of them is made.
IDS = 12
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "a bigint, b bigint, depth bigint, conv bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string"
_PEELED = f"{NODE}, parent bigint, known boolean, terms_a array<bigint>, terms_b array<bigint>, terms_n array<bigint>"
_TERMS = ("a", "b", "n")


def _placed(turns: DataFrame) -> DataFrame:
    """conv, digest (of role and text), n (code points of the text) and pos (from 1) of the turns in each conversation.

    All are sorted by range; a place is that in its range and the conversation's turns in the ranges before, so that a
    conversation with very many turns is many tasks' work."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").isNotNull().alias("numbered"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("n"),
    ).withColumn("any", F.monotonically_increasing_id())  # deals rows that are equal in all else to several ranges
    order = ["numbered", "turn", "role", "digest", "any"]
    ranges = written(slim.repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("conv", "range").agg(F.count("*").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    here = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order))
    return ranges.withColumn("here", here).join(sizes, ["conv", "range"]).select("conv", "digest", "n", (F.col("before") + F.col("here")).alias("pos"))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations (conv, pos, digest, n), and all conversations (conv)."""
    placed = written(_placed(turns), "placed")
    convs = placed.select("conv").distinct().withColumns(
        {"base": F.col("conv") - F.col("conv") % FAMILY, "h": F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS}
    )
    first = placed.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "n"))).alias("heads"))
    taken = F.coalesce(F.slice("heads", F.lit(1), F.col("h").cast("int")), F.expr("array()").cast("array<struct<pos:bigint,digest:string,n:bigint>>"))
    plans = written(convs.join(heads, "base", "left").select("conv", "h", taken.alias("taken")), "plans")
    shared = plans.select("conv", F.explode("taken").alias("t")).select("conv", "t.pos", "t.digest", "t.n")
    own = placed.join(plans.select("conv", "h", F.size("taken").alias("m")), "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "n")
    return shared.union(own), plans.select("conv")


def _segments(turns: DataFrame) -> DataFrame:
    """Rebuilt conversations by blocks: conv, k (the block), depth and key (a, b) at its end there, the terms of its turns
    and whether it ends.

    A prefix is told by the exclusive or of a 128-bit term of each turn (its digest and place), so a turn is stripped from
    a key without the turns before it.
    """
    each = turns.select("conv", ((F.col("pos") - 1) / BLOCK).cast("long").alias("k"), "pos", F.xxhash64("digest", "pos").alias("a"), F.xxhash64("pos", "digest").alias("b"), "n")
    rows = each.groupBy("conv", "k").agg(F.array_sort(F.collect_list(F.struct("pos", *_TERMS))).alias("t"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    upto, all_ = Window.partitionBy("conv").orderBy("k"), Window.partitionBy("conv")
    return rows.select(
        "conv", "k", (F.col("k") * BLOCK + F.size("t")).alias("depth"), F.bit_xor("xa").over(upto).alias("a"), F.bit_xor("xb").over(upto).alias("b"),
        *[F.col(f"t.{c}").alias(f"terms_{c}") for c in _TERMS],
        (F.col("k") == F.max("k").over(all_)).alias("ends_here"),
    )


def _digests(ended: DataFrame) -> DataFrame:
    """a, b and ends: the digest of the decimal ids (conv) that end at each key, ascending. Ids are joined by ranges and
    then digested range by range, as a stream, so no key's ids are ever held together."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in batches:
            done = []
            for a, b, ids in zip(pdf["a"].tolist(), pdf["b"].tolist(), pdf["ids"]):
                if (a, b) != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pd.DataFrame(done, columns=["a", "b", "ends"])
        if state is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=["a", "b", "ends"])

    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    by_range = ended.groupBy("a", "b", F.shiftright("conv", IDS).alias("at")).agg(ids.alias("ids"))
    return by_range.repartition("a", "b").sortWithinPartitions("a", "b", "at").select("a", "b", "ids").mapInPandas(digest, "a bigint, b bigint, ends string")


def _together(items: DataFrame) -> DataFrame:
    """Items (nodes that are not whole yet) of one key as one: what ended there and what its children have."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    terms = [F.first(f"terms_{c}").alias(f"terms_{c}") for c in _TERMS]
    return items.groupBy("a", "b", "depth").agg(F.min("conv").alias("conv"), *sums, F.max("ends").alias("ends"), *terms)


def _whole(items: DataFrame) -> DataFrame:
    """_together(), with what a node adds itself: a leaf, and what its last turn saves."""
    own = (F.col("n_convs") - 1) * F.element_at("terms_n", -1)
    return _together(items).withColumns({"n_leaves": F.greatest("n_leaves", F.lit(1)), "saved": F.col("saved") + own})


def _stripped(nodes: DataFrame) -> DataFrame:
    """What nodes are to their parents: items that are one turn shorter."""
    last = {c: F.element_at(f"terms_{c}", -1) for c in ("a", "b")}
    short = [F.slice(f"terms_{c}", F.lit(1), F.size(f"terms_{c}") - 1).alias(f"terms_{c}") for c in _TERMS]
    return nodes.select(
        *[F.col(c).bitwiseXOR(last[c]).alias(c) for c in ("a", "b")], (F.col("depth") - 1).alias("depth"), "conv", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved",
        F.lit(None).cast("string").alias("ends"), *short,
    )


def peeled(items: pd.DataFrame, base: int) -> list[tuple]:
    """All nodes down to each item's cut (a number of turns) of a block that begins behind depth base, as rows of _PEELED.

    One pass from the deepest items up: items that end at a depth join the nodes that are left there, each node is
    complete then, gives its sums to the node without its last turn, and goes. A node is known when its parent is."""
    ends_at: dict[int, list] = {}
    for row in items.itertuples(index=False):
        ends_at.setdefault(row.depth - base, []).append(row)
    rows: list[tuple] = []
    alive: dict[tuple, list] = {}
    waiting: list[tuple[list, list]] = []
    # a node: conv, n_convs, n_children, n_leaves, saved, ends, terms (a, b, n), cut
    for d in range(max(ends_at, default=0), 0, -1):
        for r in ends_at.get(d, ()):
            own = (r.conv, r.n_convs, r.n_children, r.n_leaves, r.saved)
            node = alive.get((r.a, r.b))
            if node is None:
                alive[r.a, r.b] = [*own, r.ends, (r.terms_a.tolist(), r.terms_b.tolist(), r.terms_n.tolist()), r.cut]
            else:
                node[0] = min(node[0], own[0])
                for i in range(1, 5):
                    node[i] += own[i]
                node[5] = node[5] or r.ends
        rows += [(*row, parent[0], True, None, None, None) for row, parent in waiting]
        waiting, shorter = [], {}
        for (a, b), node in alive.items():
            conv, n_convs, n_children, n_leaves, saved, ends, terms, cut = node
            n_leaves, saved = n_leaves or 1, saved + (n_convs - 1) * terms[2][d - 1]
            row = (a, b, base + d, conv, n_convs, n_children, n_leaves, saved, ends)
            if d == cut:
                rows.append((*row, None, False, *[t[:d] for t in terms]))
                continue
            key = (a ^ terms[0][d - 1], b ^ terms[1][d - 1])
            parent = shorter.get(key)
            if parent is None:
                parent = shorter[key] = [conv, n_convs, 1, n_leaves, saved, None, terms, cut]
            else:
                parent[0] = min(parent[0], conv)
                parent[1] += n_convs
                parent[2] += 1
                parent[3] += n_leaves
                parent[4] += saved
            waiting.append((row, parent))
        alive = shorter
    return rows


def _with_cuts(items: DataFrame) -> DataFrame:
    """items with the prefix at which their task stops (ca, cb, and cut: its turns in the block): the shortest of 1, 2, 4 ..
    turns below which there are no more than GROUP_TURNS; null where there is none. Items that share a prefix choose alike."""

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for a, b, ta, tb in zip(pdf["a"].tolist(), pdf["b"].tolist(), pdf["terms_a"], pdf["terms_b"]):
                xa, xb = np.bitwise_xor.accumulate(ta), np.bitwise_xor.accumulate(tb)
                cut = 1
                while cut <= len(xa):
                    out.append((a, b, cut, a ^ int(xa[-1]) ^ int(xa[cut - 1]), b ^ int(xb[-1]) ^ int(xb[cut - 1]), len(xa) - cut + 1))
                    cut *= 2
            yield pd.DataFrame(out, columns=["a", "b", "cut", "ca", "cb", "weight"])

    each = written(items.select("a", "b", "terms_a", "terms_b").mapInPandas(prefixes, "a bigint, b bigint, cut int, ca bigint, cb bigint, weight bigint"), "prefixes")
    small = each.groupBy("ca", "cb").agg(F.sum("weight").alias("w")).where(F.col("w") <= GROUP_TURNS).select("ca", "cb")
    cuts = each.join(small, ["ca", "cb"]).groupBy("a", "b").agg(F.min(F.struct("cut", "ca", "cb")).alias("c")).select("a", "b", "c.*")
    return items.join(cuts, ["a", "b"], "left")


def _peel_block(items: DataFrame, base: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of one block, as of _slim(), and what those at its first depth are to their parents."""
    items = written(_with_cuts(items), "items")

    def peel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # whole groups of a batch are peeled together; the last one may go on in the next batch
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = (pdf["ca"] == pdf["ca"].iloc[-1]) & (pdf["cb"] == pdf["cb"].iloc[-1])
            rest, whole = pdf[last], pdf[~last]
            if len(whole):
                yield _frame(peeled(whole, base))
        if rest is not None and len(rest):
            yield _frame(peeled(rest, base))

    local = items.where(F.col("cut").isNotNull()).repartition("ca", "cb").sortWithinPartitions("ca", "cb")
    local = written(local.mapInPandas(peel, _PEELED), "peeled")
    tops = items.where(F.col("cut").isNull()).drop("cut", "ca", "cb")
    cut_nodes = local.where(~F.col("known"))
    deepest = max(tops.agg(F.max("depth")).first()[0] or base, (cut_nodes.agg(F.max("depth")).first()[0] or base + 1) - 1)
    nodes, above = [_slim(local)], None
    for depth in range(deepest, base, -1):
        parts = [tops.where(F.col("depth") == depth), _stripped(cut_nodes.where(F.col("depth") == depth + 1)), *([_stripped(above)] if above is not None else [])]
        above = written(_whole(reduce(DataFrame.unionByName, parts)), "level")
        nodes.append(_slim(above.withColumns({"parent": F.lit(None).cast("long"), "known": F.lit(False)})))
    at_first = cut_nodes.where(F.col("depth") == base + 1)
    return nodes, _stripped(at_first) if above is None else _stripped(at_first).unionByName(_stripped(above))


def _slim(nodes: DataFrame) -> DataFrame:
    """Nodes without terms; those whose parent is not known with its key."""
    key = [F.col(c).bitwiseXOR(F.element_at(f"terms_{c}", -1)).alias(f"p{c}") for c in ("a", "b")]
    return nodes.select(*[c.split()[0] for c in NODE.split(", ")], "parent", "known", *key)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PEELED.split(", ")]).astype({"parent": "Int64"})


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of conversations (conv_id, turn, role, text), which are rebuilt first: each takes up to
    five turns, a number that follows from its id, from the first of its family of a hundred ids, instead of its own.

    Returns for each node conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points that members repeat, in the subtree) and ends_sha256 (of the ids that end there).

    Truncation peeling, a block of BLOCK depths at a time, the deepest first: conversations that end at a depth, equal
    ones as one, join the nodes that are left there; the last turn is stripped, what has become equal is one node, and so
    on up. Sums of a subtree go along, so nodes are found and counted in the same pass. A prefix with up to GROUP_TURNS
    turns below it is one task's work in memory; above such prefixes Spark does a depth at a time by partial sums, so that
    a turn with which a third of all conversations begin is no task's group. Of texts only digests and lengths are
    shuffled.

    Defined cases: turns are ordered by turn, nulls first, equal ones by role and digest; repeated rows are turns each;
    rows without conv_id belong to no conversation and take no part; a null role or text is empty; the remainder of a
    negative id is negative, as in SQL; other columns are ignored; no conversation gives no node.
    """
    ship(turns.sparkSession)
    rebuilt, convs = _rebuilt(turns)
    segments = written(_segments(rebuilt), "segments")
    empty = convs.join(segments.select("conv").distinct(), "conv", "left_anti")
    last = segments.where("ends_here")
    nothing = F.lit(0).cast("long")
    digests = written(_digests(last.select("a", "b", "conv").union(empty.select(nothing.alias("a"), nothing.alias("b"), "conv"))), "digests")
    best = last.groupBy("a", "b").agg(F.min(F.struct("conv", "k", "depth", *[f"terms_{c}" for c in _TERMS])).alias("m"), F.count("*").alias("n_convs"))
    counts = {c: nothing for c in ("n_children", "n_leaves", "saved")}
    ended = written(best.select("a", "b", "m.*", "n_convs").join(digests, ["a", "b"]).withColumns(counts), "ended")

    nodes: list[DataFrame] = []
    left: DataFrame | None = None
    for k in range(segments.agg(F.max("k")).first()[0] if not segments.isEmpty() else -1, -1, -1):
        items = ended.where(F.col("k") == k).drop("k")
        if left is not None:
            own = segments.where(F.col("k") == k).select("conv", *[f"terms_{c}" for c in _TERMS])
            items = items.unionByName(_together(left).drop(*[f"terms_{c}" for c in _TERMS]).join(own, "conv"))
        found, left = _peel_block(written(_together(items), "block"), k * BLOCK)
        nodes += found
        left = written(left, "left")

    none = empty.agg(F.min("conv").alias("conv"), F.count("*").alias("n"))
    below = _sums(left) if left is not None else None
    first = none.first()
    conv = min((x for x in (first.conv, below.conv if below else None) if x is not None), default=None)
    if conv is None:
        return turns.sparkSession.createDataFrame([], _RESULT)
    at_root = digests.where("a = 0 AND b = 0").first() if first.n else None
    children = below.n_children if below else 0
    root = turns.sparkSession.createDataFrame(
        [(conv, 0, None, first.n + (below.n_convs if below else 0), children, below.n_leaves if children else 1, below.saved if below else 0, at_root.ends if at_root else EMPTY)], _RESULT
    )
    if not nodes:
        return root
    every = reduce(DataFrame.unionByName, nodes)
    # parents that were not known: nodes that Spark made, nodes at a block's end, and the root
    parents = reduce(DataFrame.unionByName, [n.where(~F.col("known") | (F.col("depth") % BLOCK == 0)) for n in nodes])
    parents = parents.select(F.col("conv").alias("conv_of"), F.col("a").alias("pa"), F.col("b").alias("pb"))
    orphans = every.where(~F.col("known") & (F.col("depth") > 1))
    if orphans.isEmpty():
        found = every.withColumn("parent", F.when(F.col("known"), F.col("parent")).otherwise(F.lit(conv)))
        return _shown(found).union(root)
    placed = orphans.join(parents, ["pa", "pb"]).withColumn("parent", F.col("conv_of"))
    known = every.where(F.col("known") | (F.col("depth") == 1)).withColumn("parent", F.when(F.col("depth") == 1, F.lit(conv)).otherwise(F.col("parent")))
    return _shown(known).union(_shown(placed)).union(root)


_RESULT = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _sums(items: DataFrame):
    return items.agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]).first()


def _shown(nodes: DataFrame) -> DataFrame:
    ends: Column = F.coalesce("ends", F.lit(EMPTY))
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), ends.alias("ends_sha256"))
