from __future__ import annotations

from marketlake.llm import decontaminate as D


def found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    out = sorted((r.doc_id, r.item_id, r.distance) for r in D.find_contamination(d, b).collect())
    assert {r.doc_id for r in D.decontaminate(d, b).collect()} == set(range(len(docs))) - {k for k, _, _ in out}
    return out


def test_short_items_match_as_they_are(spark):
    docs = ["So: who wrote Hamlet? He did.", "who once wrote Hamlet", "who wrote Hamlets", "Who wrote hamlet"]
    assert found(spark, docs, ["Who wrote Hamlet?"]) == [(0, 0, 0), (3, 0, 0)]


def test_scripts_without_spaces(spark):
    long_item, short, thai = "光合作用发生在植物细胞的哪个部分?请选择正确答案。", "水是什么?", "น้ำเดือดที่กี่องศา"
    docs = [
        f"前文没有标点{long_item[:-1]}后文也没有",  # not between the same separators
        "题目\uff0c光合作用发生在植物细胞里的哪个部分\uff0c请选择正确的答案",  # two characters more
        "今天我们问水是什么再回答",
        "今天我们问水是怎么再回答",
        f"คำถามคือ{thai}ครับ",
        "完全不同的一段文字,与考题无关。",
    ]
    assert found(spark, docs, [long_item, short, thai]) == [(0, 0, 0), (1, 0, 2), (2, 1, 0), (4, 2, 0)]


def test_full_width_marks_part_words(spark):
    assert found(spark, ["alpha\uff0cbeta\uff1fgamma\u3001delta epsilon"], ["alpha beta gamma delta epsilon"]) == [(0, 0, 0)]
