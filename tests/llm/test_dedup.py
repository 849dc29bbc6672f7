from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import line_dedup as N
from marketlake.llm import simhash as S
from marketlake.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {g: min((x for x in v if x is not None), default=None) for g, v in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


@given(st.text(alphabet="abAB é\x1c İ\t\n\x0b\x0c\r,", max_size=60))
def test_fingerprint(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_long_text(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000))
    want = brute_fingerprint(text)
    monkeypatch.setattr(S, "_SHINGLES", 999)
    assert S.fingerprint(text) == want


def test_code_is_perfect():
    _, (near, *_) = S.coset_words(2)
    assert near.shape == (1 << S.CHECKS, 1) and all(v.bit_count() <= S.RADIUS for v in near[:, 0].tolist())


@settings(max_examples=30)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=2))
def test_anchor_of_each_is_among_replicas_of_the_other(x, flips):
    y = x ^ sum(1 << b for b in flips)
    own, number, anchor = S.anchors(np.array([x, y], dtype=np.uint64))
    assert own[0] in anchor[number == 1] and own[1] in anchor[number == 0]


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    base = "one two three four five six seven eight nine ten"
    odd = [(-5, None), (9001, ""), (9002, " \n"), (None, base), (9003, base), (9003, base), (9004, base.upper()), (None, "lonely words here only"), (9005, "a"), (9006, "A b"), (9007, "word " * 50_000)]
    both = docs.union(spark.createDataFrame(odd, docs.schema)).withColumns({"f": F.lit("x"), "component_id": F.lit("y")})
    got = S.near_duplicates(both).collect()
    prints = [int(r.fingerprint, 16) for r in got]
    assert len(got) == docs.count() + len(odd)
    texts = both.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, int(r.fingerprint, 16)) for r in got) == sorted((r.doc_id is None, r.doc_id or 0, brute_fingerprint(r.text)) for r in texts)
    assert [r.component_id for r in got] == brute_components([r.doc_id for r in got], prints)
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_fingerprints_and_their_replicas_are_never_broadcast(spark):
    docs = spark.createDataFrame([(i, f"w{i} x{i} y{i}") for i in range(9)], "doc_id bigint, text string")
    prints = spark.range(9).select(F.xxhash64("id").alias("f"))
    for found in (S.links(prints), S.near_duplicates(docs)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_chains_of_fingerprints(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(25):
            prints.append(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                x ^= 1 << b
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = {r.f: r.root for r in S.classes(spark.createDataFrame([(p,) for p in signed], "f bigint")).collect()}
    want = brute_components(list(range(len(prints))), prints)
    groups = {}
    for p, w in zip(signed, want):
        groups.setdefault(w, set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    rng = random.Random(1)
    edges = [e if rng.random() < 0.5 else e[::-1] for e in path + star] + [(5000, 5000), (0, 1)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{i: 1000 for i in range(1001, 1300)}}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_of_each_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(3, base, "en", "s", 1), (1, base, "en", "s", 1), (1, base, "en", "s", 1), (7, "quite another text that stands alone", "en", "s", 2), (None, None, None, None, None), (None, "", None, None, None), (9, None, "en", "s", 0)]
    names = ["root", "row", "fingerprint", "__row", "__fingerprint"]
    out = S.drop_near_duplicates(spark.createDataFrame(rows, DOCS).withColumns({n: F.lit("mine") for n in names}))
    assert all(r[n] == "mine" for r in out.collect() for n in names)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.root) for r in out.collect()) == [(False, 1, "mine"), (False, 7, "mine"), (False, 9, "mine")]
    nulls = S.drop_near_duplicates(spark.createDataFrame([(None, "a b c d", None, None, None)] * 3, DOCS))
    assert nulls.count() == 1


def brute_lines(rows, ratio, least, copies):
    pages = {}
    for _, text, host in rows:
        if host is not None:
            pages.setdefault(host, []).append(text)
    drop = {}
    for host, texts in pages.items():
        texts = texts if copies else set(texts)
        count = {}
        for t in texts:
            for line in set((t or "").split("\n")) if t is not None else ():
                count[line] = count.get(line, 0) + 1
        drop[host] = {k for k, n in count.items() if k.strip(" ") and n >= least and n > ratio * len(texts)}
    return [(i, t if t is None else "\n".join(x for x in t.split("\n") if x not in drop.get(h, ())), h) for i, t, h in rows]


@pytest.mark.parametrize("copies", [True, False])
@pytest.mark.parametrize("limit", [10**6, 0])  # broadcast or shuffled
def test_lines_against_brute_force(spark, monkeypatch, limit, copies):
    monkeypatch.setattr(N, "BROADCAST_LINES", limit)
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice(["menu", "foot", "", " ", f"own {i}", "é|[x]"]) for _ in range(rng.randint(1, 6))), rng.choice(["a", "a", "b", "c", None])) for i in range(300)]
    rows += [(None, None, "a"), (5, "menu", None), (6, "", "a"), (7, "long " * 100_000 + "\nmenu", "b"), (8, "menu", "a"), (8, "menu", "a")]
    rows += [(9, "a page that is\ncopied often", "d")] * 5 + [(10 + i, f"page {i}", "d") for i in range(3)]
    names = ["__x", "host", "keys", "a", "site", "_site", "drop", "here", "__site", "__drop", "__here", "of", "ta"]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({n: F.lit(n) for n in names})
    out = N.drop_boilerplate_lines(df, ratio=0.3, min_pages=2, copies=copies)
    assert out.columns == df.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] or "")
    found = out.collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in found), key=key) == sorted(brute_lines(rows, 0.3, 2, copies), key=key)
    assert all(r[n] == n for r in found for n in names)
    assert [r.text for r in found if r.doc_id == 9 and r.source == "d"] == ["" if copies else "a page that is\ncopied often"] * 5
    assert N.drop_boilerplate_lines(df.limit(0)).count() == 0
