from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from marketlake.llm import prefix_trie as T

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, a string"


def brute(rows):
    """The nodes, from the definition; turns of one number are ordered as the docstring says."""
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    nodes: dict = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], ([], []))[0].append(c)
        nodes[seq][1].append(c)
    children: dict = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    sums: dict = {}
    for p in sorted(nodes, key=len, reverse=True):
        below = [sums[q] for q in children.get(p, [])]
        own_saved = (len(nodes[p][0]) - 1) * len(p[-1][1]) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1, own_saved + sum(b[1] for b in below))
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]][0]) if p else None, len(m), len(children.get(p, [])), *sums[p], hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest())
        for p, (m, e) in nodes.items()
    )


def found(frame):
    return sorted(tuple(r) for r in frame.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def odd_rows(seed: int):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 420), 260):
        n = rng.choice([1, 1, 2, 3, 5, 8, 12, 30])
        start = rng.randint(0, 1)
        for t in range(n):
            role, text = rng.choice(["user", "user", "bot", None]), rng.choice(["a", "a", "bb", "", None, "é" * 3])
            if t < 6 and rng.random() < 0.8:
                role, text = ("user", "hello") if t % 2 == 0 else ("bot", "hi there")
            rows.append((c, rng.choice([t + start, t + start, t, None]), role, text))
    rows += [(300, 4, "user", "again")] * 5 + [(None, 1, "user", "nobody's")]
    return rows


@pytest.mark.parametrize(("group", "block"), [(4096, 512), (40, 512), (5, 8), (60, 4)])
def test_against_brute_force(spark, monkeypatch, group, block):
    monkeypatch.setattr(T, "GROUP_TURNS", group)
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "IDS", 3)
    rows = odd_rows(group + block)
    turns = spark.createDataFrame([(*r, "mine") for r in random.Random(2).sample(rows, len(rows))], TURNS).repartition(3)
    assert found(T.prefix_trie(turns)) == brute(rows)


def test_given_conversations(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    assert found(T.prefix_trie(turns)) == brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_copies_and_long_conversations(spark):
    rows = [(c, t, "user", "same") for c in range(1000, 1040) for t in range(7)]
    rows += [(5, t, "user", str(t)) for t in range(1100)] + [(6, t, "user", str(t)) for t in range(1030)]
    turns = spark.createDataFrame([(*r, None) for r in rows], TURNS)
    got = found(T.prefix_trie(turns))
    assert got == brute(rows) and max(r[1] for r in got) > 1024


def test_turnless_conversations_and_no_rows(spark):
    one = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1][:4]  # no base, all own turns are replaced
    rows = [(c, 0, "user", "gone") for c in one]
    assert found(T.prefix_trie(spark.createDataFrame([(*r, None) for r in rows], TURNS))) == brute(rows)
    rows += [(200, 0, "user", "x")]
    assert found(T.prefix_trie(spark.createDataFrame([(*r, None) for r in rows], TURNS))) == brute(rows)
    assert T.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert T.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", None)], TURNS)).collect() == []
