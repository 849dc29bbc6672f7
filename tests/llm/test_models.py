from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import language_id as L
from marketlake.llm import quality as Q
from marketlake.llm.shared import token_hashes

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify_languages(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(out) == docs.count()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    test = out[out.held_out]
    assert len(test) > 100 and (test.lang_pred == test.lang).mean() > 0.99
    assert out.score.between(0, 1).all()


def test_language_edge_cases(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300").select("doc_id", "text", "lang")
    text = train.where("lang = 'de'").first().text
    odd = spark.createDataFrame([(9001, None, "en"), (9002, "", "de"), (9003, "12 34 !?", None), (None, text, "zz"), (9005, text * 2000, None), (9005, text * 2000, None)], train.schema)
    model = L.train_language_model(train)
    assert model.languages == ["de", "en", "es", "fr"] and set(model.families) == {"germanic", "romance"} and set(model.pairs) == {("de", "en"), ("es", "fr")}
    got = [(r.doc_id, r["__language"].lang_pred, r["__language"].score) for r in L.predicted(odd.withColumn("score", F.lit("x")), model).collect()]
    assert [g[1] for g in got] == ["und", "und", "und", "de", "de", "de"] and got[0][2] == 0 and got[4] == got[5]
    none = L.identify_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert L.identify_languages(train.limit(0)).count() == 0
    one = L.identify_languages(train.withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in one.collect()} == {"en"}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_counts_do_not_depend_on_slices(monkeypatch, size):
    text = "Älpha  beta, 12 gamma. \n é" * 20
    whole = L.char_counts(text)
    monkeypatch.setattr(L, "SLICE", size)
    assert (L.char_counts(text) == whole).all() and whole.sum() > 900
    assert (L.features(text) ** 2).sum() == pytest.approx(1, abs=1e-4) and not L.features("").any()


@pytest.mark.parametrize(("text", "want"), [("½ ² ①② Ⅷ 12", False), ("№", False), ("_", False), ("\u0301", False), ("ª", True), ("語", True), ("1 é", True), ("", False), (None, False)])
def test_letters(text, want):
    assert L.has_letter(text) is want


def some_rows(rng, n, shift):
    rows = []
    for _ in range(n):
        idx = np.unique(rng.integers(shift, shift + 60, 20)).astype(np.int32)
        rows.append((idx, rng.random(len(idx)).astype(np.float32)))
    return rows


def test_training_against_plain_pegasos():
    rng = np.random.default_rng(3)
    first, second = some_rows(rng, 7, 0), some_rows(rng, 12, 30)
    w, ends, t = np.zeros((1 << L.BITS) + 1), [], 0
    for y, idx, val in L._schedule(first, second, 4):
        t += 1
        x = np.zeros_like(w)
        x[idx], x[-1] = val, L.BIAS
        rate = 1 / (1e-4 * (t + L.START))
        hit = y * (w @ x) < 1
        w = (1 - rate * 1e-4) * w + (rate * y * x if hit else 0)
        if t % 24 == 0:
            ends.append(w)
    want = np.mean(ends[2:], axis=0)
    got = L.fit_separator(first, second, epochs=4)
    assert np.allclose(got.weights, want[:-1], atol=1e-4) and got.bias == pytest.approx(want[-1] * L.BIAS, abs=1e-6)
    assert all(got.weights[i] @ v + got.bias > 0 for i, v in first) and all(got.weights[i] @ v + got.bias < 0 for i, v in second)


def test_many_rows_do_not_turn_the_weights():
    first, second = [(np.array([1], np.int32), np.ones(1, np.float32))] * 15_000, [(np.array([2], np.int32), np.ones(1, np.float32))] * 15_000
    s = L.fit_separator(first, second, epochs=2)
    assert s.weights[1] > 0 > s.weights[2]


def test_prediction_against_plain_duels():
    rng = np.random.default_rng(5)
    rows = []
    for k, lang in enumerate(("de", "en", "nl", "fr", "es")):
        rows += [(lang, (k * 40 + r[0]).astype(np.int32).tobytes(), r[1].tobytes()) for r in some_rows(rng, 9, 0)]
    model = L.fit(rows)
    of = {f: [x for x in ("de", "en", "nl", "fr", "es") if L.family_of(x) == f] for f in ("germanic", "romance")}
    for text in ("alpha beta", "x", "Ünï cödé und mehr", "le la les une"):
        x = L.features(text).astype(float)
        p = lambda s: 1 / (1 + np.exp(-s.slope * (s.weights.astype(float) @ x + s.bias)))
        share = {f: p(model.by_family[f]) for f in of}
        family = max(share, key=share.get)
        wins, mean = dict.fromkeys(of[family], 0), dict.fromkeys(of[family], 0.0)
        for (a, b), s in model.pairs.items():
            if a in wins:
                wins[a if p(s) >= 0.5 else b] += 1
                mean[a] += p(s) / (len(wins) - 1)
                mean[b] += (1 - p(s)) / (len(wins) - 1)
        best = max(wins, key=lambda k: (wins[k], mean[k]))
        lang, score = model.predict(text)
        assert lang == best and score == pytest.approx(share[family] / sum(share.values()) * mean[best], abs=1e-5)


def test_kept_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300").withColumns({"language": F.lit("mine"), "score": F.lit(1)})
    de = docs.where("lang = 'de'").first().text
    odd = [(9001, None), (9002, "12 ½"), (9003, "这是一个测试句子，没有空格。" * 5), (9004, de), (9004, de)]
    odd = spark.createDataFrame([(i, t, None, "s", 1, "mine", 1) for i, t in odd], docs.schema)
    out = L.keep_known_languages(docs.union(odd))
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} | {9004} and len(rows) == docs.count() + 2
    assert [r.lang for r in rows if r.doc_id == 9004] == ["de", "de"] and {r.language for r in rows} == {"mine"}
    plain = docs.union(odd).withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in L.keep_known_languages(plain).collect()} == {r.doc_id for r in docs.collect()} | {9003, 9004}
    assert L.keep_known_languages(docs.limit(0)).count() == 0


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    ones = y == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = Q.classify_quality(docs, labels).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()
    told = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    assert len(told) > 300 and auc(told.quality.to_numpy(), told.score.to_numpy()) > 0.97


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(["a b c", "d ### e", None, "", "a b c", "w " * 400_000])] + [(None, "a b", "x")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, 0, 0), (4, 1, 0), (4, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in Q.classify_quality(docs, labels).collect()}
    assert len(out) == 7 and out[2].score == out[3].score
    assert {r.score for r in Q.classify_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.classify_quality(docs.limit(0), labels).count() == 0


def test_quality_held_out_by_words_alone(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = Q.classify_quality(docs, labels, repeats=False).toPandas()
    told = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    assert auc(told.quality.to_numpy(), told.score.to_numpy()) > 0.9


def test_ftrl_against_a_plain_version():
    """One coordinate at a time, in dictionaries, by the published update."""
    rng = np.random.default_rng(4)
    rows = [(int(rng.integers(2)), np.unique(rng.integers(0, 40, 8)).astype(np.int32), None) for _ in range(60)]
    rows = [(y, i, rng.random(len(i)).astype(np.float32)) for y, i, _ in rows]
    alpha, beta, l1, l2, z, n = 0.15, 1.0, 0.02, 0.5, {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - np.sign(zi) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(3):
        for j in order.permutation(len(rows)):
            y, idx, val = rows[j]
            x = dict(zip([*idx.tolist(), "bias"], [*val.tolist(), 1.0]))
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g, before = (p - y) * v, n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / alpha * w[i]
    model = Q.fit_ftrl(rows)
    want = np.zeros(1 << Q.BITS)
    for i in z:
        if i != "bias":
            want[i] = weight(i)
    assert np.allclose(model.weights, want, atol=1e-6) and model.bias == pytest.approx(weight("bias"), abs=1e-9) and np.count_nonzero(want) > 10


def test_scores_against_plain_products():
    rng = np.random.default_rng(6)
    model = Q.QualityModel(rng.normal(size=1 << Q.BITS).astype(np.float32), 0.3)
    texts = ["one two one two three", "a", "", None, "x y z " * 500]
    for text, score in zip(texts, model.scores(texts)):
        ((_, (tokens,)),) = token_hashes([text], False)
        dot = 0.0
        if len(tokens):
            counts = {}
            for b in Q.buckets(tokens).tolist():
                counts[b] = counts.get(b, 0) + 1
            dot = sum(float(model.weights[b]) * c * Q.SCALE / sum(counts.values()) for b, c in counts.items())
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(dot + 0.3, -30, 30))), abs=1e-6)


def test_many_rows_of_one_labelled_document(spark):
    rows = [(1, f"good words {i}") for i in range(500)] + [(2, "bad bad ### bad"), (3, "good words again"), (5, "w " * 1_000_000 + "x y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (5, 0)], "doc_id bigint, quality int")
    assert Q.classify_quality(docs, labels).count() == len(rows)
    tokens = np.arange(50_000, dtype=np.uint64)
    idx, val = Q.sparse(tokens)
    assert len(idx) == len(val) == Q.MAX_FEATURES and (np.diff(idx) > 0).all()


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(0)
    rows = [(int(i % 2), np.array([i % 2, 2 + int(rng.integers(50))], np.int32), np.ones(2, np.float32)) for i in range(400)]
    model = Q.fit_ftrl(rows)
    assert model.weights[1] > 0 > model.weights[0] and np.count_nonzero(model.weights) <= 52
    assert Q.fit_ftrl([(1, *rows[0][1:])]).scores([""])[0] > 0.9


def test_scores_do_not_depend_on_neighbours():
    texts = ["one two three", None, "", "Ünï ### x\ny", "a" * 3_000_000, "z " * 900_000]
    alone = [next(iter(token_hashes([t], False)))[1][0] for t in texts]
    together = [h for _, each in token_hashes(texts, False) for h in each]
    assert len(together) == len(texts) and all((a == b).all() for a, b in zip(alone, together))
    assert len(alone[4]) == 1  # no word is cut
    assert len(alone[0]) == 3 and len(alone[3]) == 4 and len(alone[2]) == 0 and len(alone[5]) == 900_000


def test_a_text_that_many_rows_repeat_is_one_example(spark, monkeypatch):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IS NOT NULL").select("doc_id", "text", "lang")
    (one,) = base.where("lang = 'de'").orderBy("doc_id").limit(1).collect()
    copies = spark.range(4000).selectExpr("CAST(7 AS BIGINT) AS doc_id").withColumns({"text": F.lit(one.text), "lang": F.lit("de")})
    drawn = []
    monkeypatch.setattr(L, "fit", lambda rows: drawn.extend(rows) or L.LanguageModel())
    L.train_language_model(base.union(copies), max_rows=80)
    german = [(idx, val) for lang, idx, val in drawn if lang == "de"]
    assert len(german) > 10 and len(german) == len(set(german))
    drawn.clear()
    noise = spark.range(50).selectExpr("id AS doc_id", "'some words' AS text", "concat('n', id) AS lang")
    L.train_language_model(base.union(noise), max_rows=40, max_languages=3)
    assert len({lang for lang, _, _ in drawn}) == 3 and len(drawn) <= 40
