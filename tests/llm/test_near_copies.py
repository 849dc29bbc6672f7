from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import near_copies as C
from marketlake.llm.shared import mixed

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_kept(rows):
    """doc_ids of the smallest row of each component of pairs with 5-word similarity of 0.8 or more."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 0.8 * max(len(sets[i]), len(sets[j])) <= min(len(sets[i]), len(sets[j])) and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return sorted(rows[i][0] for i in range(len(rows)) if find(i) == i)


def test_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    odd = [(-1, None), (9_000_001, ""), (9_000_002, " \n"), (9_000_003, "One two"), (9_000_004, "one  TWO")]
    for i in range(40):  # a large group of near copies, and a chain that leads away from it
        words = list(base)
        words[rng.randrange(100)] = f"x{i}"
        odd.append((9_000_100 + i, " ".join(words)))
    for i in range(12):
        odd.append((9_000_200 + i, " ".join([f"c{i + j}" for j in range(60)])))
    odd += [(9_000_300, " ".join(base[:83])), (9_000_301, " ".join(base[:60]))]
    both = docs.union(spark.createDataFrame([(i, t, None, None, 0) for i, t in odd], DOCS)).withColumns({"node": F.lit("mine")})
    out = corpus_pipeline.near_dedup(spark, both, SF)
    assert out.columns == both.columns
    got = sorted(r.doc_id for r in out.collect())
    assert got == brute_kept([(r.doc_id, r.text) for r in both.select("doc_id", "text").collect()])
    assert 9_000_101 not in got and 9_000_300 not in got and 9_000_301 in got


def test_repeated_and_null_ids(spark):
    rows = [(None, "a b c d e f g", None, None, 7)] * 3 + [(2, "k l m n o p", "en", "s", 1)] * 2
    assert sorted(str(r.doc_id) for r in C.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect()) == ["2", "None"]
    assert C.drop_near_copies(spark.createDataFrame([], DOCS)).count() == 0


def test_fingerprints_against_brute_force():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100):
        features = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        want = []
        for seed in C._SEEDS[: C.PRINTS]:
            each = mixed(features ^ seed).tolist()
            want.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in each) > n))
        assert C.fingerprints(features).tolist() == want
    assert (C.fingerprints(np.empty(0, np.uint64)) == 0).all()


@pytest.mark.parametrize("rate", [0.005, 0.02])
def test_large_groups_of_near_copies(spark, rate):
    """Edits of edits of one text: links between any two different sets count, however they are connected."""
    rng = random.Random(7)
    texts = [[f"w{rng.randrange(3000)}" for _ in range(150)]]
    for i in range(400):
        texts.append([f"e{i}x{k}" if rng.random() < rate else w for k, w in enumerate(rng.choice(texts))])
    rows = [(i, " ".join(t), None, None, 0) for i, t in enumerate(texts)]
    got = sorted(r.doc_id for r in C.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect())
    assert got == brute_kept([r[:2] for r in rows])


def test_columns_of_any_name(spark):
    rows = [(1, "one two three", "a", 5, "s"), (2, "one two three", "b", 6, "t"), (3, None, "c", 7, "u")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row string, sketch int, node string").withColumns({"_row": F.lit("mine"), "k": F.lit(1), "u": F.lit(2)})
    out = C.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(tuple(r)[:6] for r in out.collect()) == [(1, "one two three", "a", 5, "s", "mine"), (3, None, "c", 7, "u", "mine")]


@pytest.mark.parametrize("kind", ["appended", "replaced", "removed", "middle"])
def test_recall_near_the_threshold(spark, kind):
    """Pairs of similarity 0.8 to 0.85 are all found, whatever was done to the words."""
    rng, rows = random.Random(5), []
    for i in range(60):
        size = rng.randrange(40, 400)
        words, other = [f"p{i}w{rng.randrange(5000)}" for _ in range(size)], None
        n = size - 4
        if kind == "appended":  # all of it new words
            other = words + [f"a{i}x{k}" for k in range(int(n / 0.81) - n)]
        elif kind == "removed":
            other = words[: size - int(n * 0.18)]
        elif kind == "middle":
            other = [*words[: size // 2], *[f"m{i}x{k}" for k in range(max(1, int(n / 0.84) - n - 4))], *words[size // 2 :]]
        else:
            other = list(words)
            for k in range(5, size - 5, 100):
                other[k] = f"r{i}x{k}"
        rows += [(2 * i, " ".join(words), None, None, 0), (2 * i + 1, " ".join(other), None, None, 0)]
    got = sorted(r.doc_id for r in C.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect())
    want = brute_kept([r[:2] for r in rows])
    assert got == want and len(want) < 70


def test_sets_of_one_passage(spark):
    """A passage that all texts hold is neither a link nor a reason to compare them; sizes and parities lose no link."""
    rng = random.Random(6)
    passage = [f"s{k}" for k in range(60)]
    rows = [(i, " ".join([*passage, *[f"t{i}w{k}" for k in range(rng.randrange(5, 60))]]), None, None, 0) for i in range(300)]
    rows += [(1000 + i, f"a short text of number {i % 7} and no more {i % 3}", None, None, 0) for i in range(40)]
    got = sorted(r.doc_id for r in C.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect())
    assert got == brute_kept([r[:2] for r in rows])


def test_bounds_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        common, a, b = (rng.integers(0, 1 << 64, rng.integers(0, n), dtype=np.uint64) for n in (300, 40, 40))
        x, y = np.union1d(common, a), np.union1d(common, b)
        differ = int(np.bitwise_count(C.parities(x) ^ C.parities(y)).sum())
        assert differ <= len(np.setxor1d(x, y))
        if len(x) and len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)):
            assert len(np.intersect1d(x, y)) >= max(C.needed(len(x)), C.needed(len(y)))
            first = [s[: len(s) - C.needed(len(s)) + 1 + len(s) // C.MORE] for s in (x, y)]
            assert len(np.intersect1d(*first)) >= 1 + max(C.needed(len(x)), C.needed(len(y))) // C.MORE


def test_rarest_shingles_of_a_group(spark):
    """Texts of one group that are not similar enough meet at few of the shingles that they share, similar ones at one at least."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(400), rng.randrange(4, 7)):
            words[at] = f"x{i}p{at}"
        rows.append((i, " ".join(words)))
    sets = [C.shingles(t) for _, t in rows]
    known = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "node bigint, s array<bigint>")
    nodes = spark.createDataFrame([(i, i, len(s), C.parities(s).view(np.int64).tolist()) for i, s in enumerate(sets)], "node bigint, root bigint, n int, compared array<bigint>")
    heads = C._heads(nodes, known, 0.8)
    met = [(r.u, r.v) for r in C._sharing(heads, 0.8).select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).collect()]
    similar = {(i, j) for j in range(120) for i in range(j) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    assert len(similar) > 100 and similar <= set(met)
    every = heads.alias("a").join(heads.alias("b"), "s").where(C._near(F.col("a.x"), F.col("b.x"), 0.8) & (F.col("a.x.node") < F.col("b.x.node")))
    assert len(met) < every.count() / 5
