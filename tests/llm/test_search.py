from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import decontaminate as D
from marketlake.llm import topk as K
from marketlake.llm.shared import token_hashes

WORDS = ["the", "of", "and", "alpha", "beta", "gamma", "delta", "night", "river", "stone"]


def brute_distance(pattern, text):
    """Sellers' algorithm: (distance, first end)."""
    col = list(range(len(pattern) + 1))
    best, end = col[-1], 0
    for j, w in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(col[i - 1] + (p != w), col[i] + 1, new[i - 1] + 1))
        col = new
        if col[-1] < best:
            best, end = col[-1], j
    return best, end


@given(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.lists(st.integers(0, 4), max_size=120))
def test_myers(pattern, text):
    assert D.distance_in(np.array(pattern, np.uint64), np.array(text, np.uint64)) == brute_distance(pattern, text)


def changed(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = f"new{rng.randrange(1000)}"
        elif kind == 1:
            del words[i]
        else:
            words.insert(i, f"add{rng.randrange(1000)}")
    return words


def test_contamination_against_brute_force(spark):
    rng = random.Random(4)
    items = [[rng.choice(WORDS) + str(rng.randrange(3)) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    docs = []
    for i in range(80):
        words = [rng.choice(WORDS) + str(rng.randrange(3)) for _ in range(rng.randint(0, 60))]
        if i % 2:
            item = rng.choice(items)
            at = rng.randint(0, len(words))
            words[at:at] = changed(rng, item, rng.randint(0, int(len(item) * 0.3)))
        docs.append((i, rng.choice([" ", ", ", ".\n", "  - "]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    docs += [(None, " ".join(items[0])), (200, None), (201, ""), (202, "pad " * 60_000 + " ".join(items[1]) + " pad" * 10), (0, docs[0][1])]
    bench = [(k, " ".join(w)) for k, w in enumerate(items)] + [(0, " ".join(items[0])), (50, None), (51, ""), (52, "the of"), (None, " ".join(items[2]))]
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id bigint, text string, item_id int, distance int")
    b = spark.createDataFrame(bench, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted(((r.doc_id, r.item_id, r.item_words, r.distance) for r in D.find_contamination(d, b).collect()), key=key)
    want = []
    for doc, text in docs:
        words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        for k, item in [*enumerate(items), (None, items[2])]:
            distance, _ = brute_distance(item, words)
            if distance <= int(len(item) * D.ERROR_RATE):
                want.append((doc, k, len(item), distance))
    assert got == sorted(want, key=key) and len(want) > 20
    left = sorted(((r.doc_id, r.text) for r in D.decontaminate(d, b).collect()), key=lambda r: key((r[0],)))
    bad = {w[0] for w in want}
    assert [x[0] for x in left] == sorted((x[0] for x in docs if x[0] not in bad), key=lambda v: key((v,)))


def test_match_spans_and_blocks(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(20))
    d = spark.createDataFrame([(1, f"a b c {item} d")], "doc_id bigint, text string")
    b = spark.createDataFrame([(1, item), (2, item.replace("w3 ", "w3 x ")), (3, "z " * 30)], "item_id bigint, text string")
    one = sorted(tuple(r) for r in D.find_contamination(d, b).collect())
    assert one == [(1, 1, 20, 0, 3, 23), (1, 2, 21, 1, 3, 23)]
    monkeypatch.setattr(D.blocks_of, "__defaults__", (40,))
    assert sorted(tuple(r) for r in D.find_contamination(d, b).collect()) == one
    assert D.decontaminate(d, b).count() == 0
    assert D.find_contamination(d, b.limit(0)).count() == 0 and D.decontaminate(d, b.limit(0)).count() == 1
    assert D.find_contamination(d.limit(0), b).count() == 0


def test_planted_passages_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = {r.item_id: flat(r.text) for r in bench.collect()}
    exact = {(r.doc_id, k) for r in docs.collect() for k, t in items.items() if f" {t} " in f" {flat(r.text)} "}
    got = {(r.doc_id, r.item_id) for r in D.find_contamination(docs, bench).collect()}
    assert exact <= got and len(exact) > 10


def brute_top(rows, k=5, every=50):
    ok = []
    for n, (i, e) in enumerate(rows):
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            ok.append((n, i, [math.floor(256 * x) if abs(x) < 2**53 else 256 * int(x) for x in e]))
    out = []
    for n, i, q in ok:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in ok if m != n and len(v) == len(q))[:k]
            out += [(i, rank, j, min(max(-s, -(2**63)), 2**63 - 1)) for rank, (s, j) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 60, "block_rows": 2}])
def test_top_k_against_brute_force(spark, sizes):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0, rng.gauss(0, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(60)]
    rows += [(1000, None), (1050, [1.0, None] * 3), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (None, [1.0] * 6), (1200, [1.0, 2.0]), (1201, [3.0, 1.0]), (1250, []), (50, rows[50][1]), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, rank int, score string")
    got = sorted(tuple(r) for r in K.exact_top_k(df, **sizes).collect())
    assert got == brute_top(rows)
    assert K.exact_top_k(df.limit(0)).count() == 0


def test_top_k_few_rows_and_large_values(spark):
    def check(rows, **kw):
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        assert sorted(tuple(r) for r in K.exact_top_k(df, **kw).collect()) == brute_top(rows, **kw)

    check([(0, [2.0**40]), (7, [-(2.0**40)])], k=3)
    check([(0, [1.0]), (1, [2.0**53]), (2, [3.0])])  # no finite component is too large
    check([(0, [1.5, -1.0]), (50, [2.0**52 + 1, 2.0**52]), (1, [2.0**51, 2.0**51]), (2, [1e15, 1e15]), (3, [-1e15, 1.0]), (4, [0.1, 0.2])], k=2)
    # beyond 64 bits the score is cut off but ranks are right
    check([(0, [2.0**50]), (1, [2.0**50]), (2, [2.0**51]), (3, [-(2.0**51)]), (4, [1e300])], k=4)
    check([(0, [1.0, 2.0])] * 300 + [(i, [float(i % 7), 1.0]) for i in range(1, 40)])


def test_copies_are_dealt_to_all_shards(spark):
    rows = spark.range(4000).selectExpr("CAST(1 AS BIGINT) AS row").withColumn("row", F.monotonically_increasing_id())
    sizes = [r["count"] for r in rows.groupBy(F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(40))).count().collect()]
    assert len(sizes) == 40 and max(sizes) < 200


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5), st.integers(0, 10**6))
def test_tree_prunes_nothing_that_counts(n, k, seed):
    rng = np.random.default_rng(seed)
    v, q = rng.integers(-5, 6, (n, 3)), rng.integers(-5, 6, (4, 3))
    tree = K.Tree(np.arange(n), np.arange(n), v, leaf=8)
    bounds = tree.bounds(q)
    for i in range(4):
        scores = v @ q[i]
        want = sorted((-int(s), j) for j, s in enumerate(scores) if j != i)[:k]
        assert tree.search(i, q[i], bounds[i], k, -np.inf) == want
        assert tree.search(i, q[i], bounds[i], k, -want[-1][0] if want else 0) == want


def test_words():
    ((_, (a, b)),) = token_hashes(["Ab-c1 é", "ab C1"], True)
    assert len(a) == 3 and a[0] == b[0] and a[1] == b[1]
    ((_, (c, d, e)),) = token_hashes(["“ab”—c1…\u3002é\xa0x", "ab c1 é x", "ÂâÃã"], True)
    assert c.tolist() == d.tolist() and len(e) == 1
