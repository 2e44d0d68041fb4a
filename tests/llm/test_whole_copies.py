"""Copies that template windows alone don't find."""

from __future__ import annotations

import random

from bondmart.llm import decontaminate
from test_models_and_search import ITEM

FILLER = "some other words that say nothing of it. "


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r)[:3] for r in decontaminate.find_items(d, b).collect())


def test_exact_copies_of_any_item_are_found(spark):
    items = dict(enumerate([
        "What is 17 * 23?", "Compute 12 + 7 - 5 + 3 * 4", "Yes", "这个城市有多少人口？", "今日は何曜日ですか。", "ราคาเท่าไร",
        "Karl 7 Karl 7 Karl 7 Karl 7 Karl 7", "Ann Lee 5 kg 6 kg 7 kg 8 kg Bob 9 kg 10 kg 11 kg Carl 12 kg 13 kg 14 kg",
        "Explain in a few words how the sum 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 is made",
        "Maria walks along the river every single day"]))
    docs = [(i, f"{FILLER}Then said Olga {t} {FILLER}" if i not in (3, 4, 5) else f"文字{t}文字") for i, t in items.items()]
    docs += [(100, "What is 17 + 23?"), (101, "what is 117 * 23"), (102, "Compute 12 + 7 - 5 + 3 * 5"), (103, "这个城市有人口"),
             (104, "yesterday"), (105, "Karl 7 " * 6), (106, "x" + items[1][1:]), (None, items[0])]
    got = found(spark, [d for d in docs if d[0] is not None], list(items.items()))
    assert got == [(i, i, 1.0) for i in items]
    d = spark.createDataFrame([(None, items[0]), (1, items[1]), (1, items[0])], "doc_id long, text string")
    b = spark.createDataFrame([(0, items[0]), (None, items[0]), (2, "?!"), (3, "+")], "item_id long, text string")
    rows = {(r.doc_id, r.item_id) for r in decontaminate.find_items(d, b).collect()}
    assert rows == {(None, 0), (None, None), (1, 0), (1, None), (1, 3)}


def test_a_copy_with_other_slots_stays_a_copy_with_other_slots(spark):
    other = ITEM.replace("Maria", "Olga")
    d = spark.createDataFrame([(1, ITEM), (2, other), (3, other + ". " + ITEM)], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    got = {r.doc_id: r.reparameterised for r in decontaminate.find_items(d, b).collect()}
    assert got == {1: False, 2: True, 3: True}


def test_passages_of_long_items_are_found(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    long, short = " ".join(words[:200]), " ".join(words[200:300])
    docs = [(1, FILLER + " ".join(words[50:150])), (2, " ".join(words[220:270]) + " " + FILLER),
            (3, " ".join(words[30:43])), (4, " ".join(words[30:42])), (5, " ".join(words[187:200])),
            (6, " ".join(words[10:22] + ["else"] + words[23:35])), (7, " ".join(words[300:]))]
    got = found(spark, docs, [(1, long), (2, short)])
    assert [(d, i) for d, i, _ in got] == [(1, 1), (2, 2), (3, 1), (5, 1)]
    assert got[0][2] == 0.5 and got[1][2] == 0.5
