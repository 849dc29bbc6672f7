from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from marketlake.llm import vector_codes as V

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, e string, code string"


def brute(rows):
    """(vec_id, code, error, label_error, codebooks_sha256), from the definition."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ids = {}
    for i, q, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: (k[0], k[1])):
        ids.setdefault(i, q)
    first = [ids[i] for i in sorted(ids)[:16]]
    n = len(first[0]) // 8
    books = [[q[p * n : p * n + n] for q in first] for p in range(8)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(6):
        for p in range(8):
            groups: dict = {}
            for _, q, _ in kept:
                x = q[p * n : p * n + n]
                groups.setdefault(near(x, books[p])[1], []).append(x)
            books[p] = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else e for j, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, errors = [], {}
    for i, q, lab in kept:
        found = [near(q[p * n : p * n + n], books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        errors[lab] = errors.get(lab, 0) + error
        out.append((i, "".join(f"{j:02x}" for _, j in found), error, lab))
    long = lambda v: v if v < 1 << 63 else None
    return sorted(((i, c, long(e), long(errors[lab]), sha) for i, c, e, lab in out), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def test_tree_finds_the_nearest_and_the_first_of_equals():
    rng = np.random.default_rng(3)
    skipped = 0
    for size, spread in ((1, 5), (2, 3), (16, 3), (16, 1000), (40, 2), (40, 10**6)):
        entries = rng.integers(-spread, spread, (size, 5))
        entries[size // 2] = entries[0]
        x = np.concatenate([rng.integers(-spread, spread, (300, 5)), entries])
        tree = V.gnat(entries, list(range(size)))
        want = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        for kind in (np.int64, object):
            best, least = V.assigned(x.astype(kind), entries.astype(kind), tree)
            assert best.tolist() == want.argmin(axis=1).tolist() and least.tolist() == want.min(axis=1).tolist()
        skipped += isinstance(tree, V.Node)
    assert skipped


def test_ranges_leave_subtrees_out(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.integers(-(10**6), 10**6, (4, 8))
    entries = np.concatenate([c + rng.integers(-50, 50, (8, 8)) for c in centres])
    asked = []
    plain = V.squared
    monkeypatch.setattr(V, "squared", lambda x, y: asked.append(len(x)) or plain(x, y))
    tree = V.gnat(entries, list(range(32)))
    asked.clear()
    V.assigned(entries[:, :].copy(), entries, tree)
    assert sum(asked) < 32 * 32 / 2


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert found(V.compress(df)) == brute([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


@pytest.mark.parametrize("large", [False, True])
def test_odd_vectors(spark, large):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.125, 3.0]) for _ in range(16)], i % 3 or None) for i in range(5, 90)]
    rows += [(7, [9.0] * 16, 1), (7, [9.0] * 16, 1), (None, [1.0] * 16, 2), (1, None, 1), (2, [1.0] * 15 + [None], 1), (3, [float("nan")] * 16, 1), (4, [float("inf")] * 16, None)]
    if large:
        rows += [(200, [3e38] * 8 + [-3e38] * 8, 1), (201, [1e12] * 16, 0)]
    df = spark.createDataFrame([(*r, "mine", "mine") for r in rows], VECTORS).repartition(4)
    assert found(V.compress(df)) == brute(rows)


def test_few_and_no_vectors(spark):
    few = [(3, [0.5] * 8, None), (9, [0.25] * 8, None)]
    assert found(V.compress(spark.createDataFrame([(*r, None, None) for r in few], VECTORS))) == brute(few)
    assert V.compress(spark.createDataFrame([(1, None, 1, None, None)], VECTORS)).collect() == []
    other = [(1, [0.5] * 8, 1, None, None), (2, [0.5] * 9, 1, None, None), (3, [], 1, None, None)]
    assert [r.vec_id for r in V.compress(spark.createDataFrame(other, VECTORS)).collect()] == [1]
    assert len(V.compress(spark.createDataFrame([(1, [0.5] * 11, 1, None, None)], VECTORS)).collect()) == 1
