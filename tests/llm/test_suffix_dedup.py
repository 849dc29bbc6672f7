from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from marketlake.llm import suffix_dedup as S

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, kept string"


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of rows in their order."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 99):
            g = data[p : p + 100]
            if g in seen:
                cover[p : p + 100] = True
            seen.add(g)
        n_spans = int((np.diff(np.r_[False, cover].astype(int)) == 1).sum())
        left = bytes(b for b, c in zip(data, cover) if not c)
        out.append((i, len(data), len(data) - len(left), n_spans, hashlib.sha256(left).hexdigest()))
    return out


def found(frame):
    return sorted(frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_removed))


def odd_texts(seed: int):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 9)))
    prose = lambda n: "".join(word() + " " for _ in range(n))
    shared = [prose(40) for _ in range(4)] + ["ab" * 90, "x" * 260]
    rows = [(0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "x" * 400)]
    for i in range(6, 80):
        rows.append((i, prose(rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 60) :] + prose(rng.randint(0, 20)) + rng.choice(shared)[: rng.randint(80, 200)]))
    rows += [(80 + i, rows[6 + i % 7][1]) for i in range(20)]
    return rows


def test_merge_of_transforms_against_sets():
    for seed in range(6):
        texts = [(t or "").encode() for _, t in odd_texts(seed)]
        want, seen = set(), set()
        for i, t in enumerate(texts):
            for p in range(len(t) - 99):
                if t[p : p + 100] in seen:
                    want.add((i, p))
                seen.add(t[p : p + 100])
        for shard in (1, 700, 1 << 20):
            text, start = S.later(texts, shard)
            assert len(text) == len(want) and set(zip(text.tolist(), start.tolist())) == want


def test_a_transform_is_in_order_and_maps_back():
    texts = [(t or "").encode() for _, t in odd_texts(9)][5:40]
    s = S.Shard(texts)
    suffix = [texts[t][p : p + 100] for t, p in zip(s.text.tolist(), s.start.tolist())]
    whole = [(x, i) for i, x in enumerate(suffix) if len(x) == 100]
    assert [i for _, i in whole] == [i for _, i in sorted(whole)]
    for i, b in enumerate(s.before.tolist()):
        assert (b < 0) == (s.start[i] < 8)
        if b >= 0:
            assert (s.text[b], s.start[b]) == (s.text[i], s.start[i] - 8)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "PART_BYTES", 3000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 5000)
    monkeypatch.setattr(S, "TASK_BYTES", 4000)
    rows = odd_texts(3)
    docs = spark.createDataFrame([(i, t, "mine") for i, t in random.Random(1).sample(rows, len(rows))], DOCS).repartition(5)
    assert [tuple(r) for r in found(S.drop_repeats(docs))] == brute(rows)


def test_hot_passages_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 50)
    monkeypatch.setattr(S, "BLOCK", 1 << 10)
    rng = random.Random(5)
    line = "".join(rng.choice("lmnopqrst ") for _ in range(140))
    rows = [(i, f"{rng.random()} {line} {rng.random()}" * rng.randint(1, 3)) for i in range(200)]
    rows.append((200, "".join(rng.choice("uvwxyz") for _ in range(9000)) + line + rows[3][1] * 20))
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], DOCS)
    assert [tuple(r) for r in found(S.drop_repeats(docs))] == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    out = S.drop_repeats(docs)
    assert [tuple(r) for r in found(out)] == brute(rows)
    for r in out.collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_repeated_and_null_ids_and_no_rows(spark):
    text = "".join(chr(97 + i % 23) + str(i) for i in range(60))
    rows = [(7, text, None)] * 3 + [(None, text, None), (None, None, None)]
    got = found(S.drop_repeats(spark.createDataFrame(rows, DOCS)))
    assert [(r.doc_id, r.n_removed) for r in got] == [(7, 0), (7, len(text)), (7, len(text)), (None, 0), (None, len(text))]
    assert S.drop_repeats(spark.createDataFrame([], DOCS)).collect() == []
