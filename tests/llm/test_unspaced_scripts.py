"""Test items in scripts without spaces between words."""

from __future__ import annotations

import llm.brute as brute
from tidemark.llm.decontamination import find_leaks

ITEM = "水在海平面的气压下加热到多少度时会开始沸腾并变成蒸汽"
THAI = "เมืองหลวงของประเทศไทยคือกรุงเทพมหานคร"


def test_embedded_and_edited_items_are_found(spark):
    edited = ITEM[:9] + "山" + ITEM[10:]
    texts = ["老师今天问了我们" + ITEM + "而没有人知道答案", "前面的文字" + edited + "后面的文字", "今天天气很好我们去公园散步", "ก" + THAI + "ข", "plain words only"]
    docs = brute.documents(spark, texts)
    table = spark.createDataFrame([(1, ITEM), (2, THAI)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in find_leaks(docs, table).collect()}
    assert set(got) == {(0, 1), (1, 1), (3, 2)}
    assert got[0, 1]["score"] == 1.0 and got[0, 1]["first_word"] == 8 and 0.9 < got[1, 1]["score"] < 1.0
