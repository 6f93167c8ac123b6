from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from farekit.llm import decontaminate, queries
from tests.llm.cases import LONG, crowded, docs


def fewest_edits(item, region):
    """Edits from the item to the nearest part of the region, the whole table filled."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(region, 1):
            row.append(min(before[j - 1] + (a != b), before[j] + 1, row[j - 1] + 1))
    return min(row)


def test_alignment_equals_the_whole_table():
    dice = random.Random(4)
    for _ in range(150):
        item = [dice.randrange(4) for _ in range(dice.randrange(8, 25))]
        part = [x for x in item if dice.random() > 0.1]
        region = [dice.randrange(4) for _ in range(dice.randrange(6))] + part + [dice.randrange(4) for _ in range(dice.randrange(6))]
        budget, exact = 4, fewest_edits(item, region)
        found = decontaminate.align(np.array(item), np.array(region, dtype=np.int64), budget)
        assert found == (exact if exact <= budget else None)


def plain(text):
    return " ".join(re.findall(r"[^\W_]+", (text or "").lower()))


def test_whole_items_are_found_in_whole_texts(spark, data_dir):
    path = data_dir.replace("sf0.001", "sf0.01")
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()}
    exact = {(r.doc_id, i) for r in rows for i, x in items.items() if x in plain(r.text)}
    found = {(r.doc_id, r.item_id): r.edits for r in queries.QUERIES["op9_decontaminate"](spark, path).collect()}
    assert exact and {k for k, e in found.items() if e == 0} == exact
    texts = {r.doc_id: plain(r.text) for r in rows}
    for (doc, item), edits in found.items():
        assert edits <= 0.08 * len(items[item]) and (edits == 0 or fewest_edits(items[item], texts[doc]) == edits)


def test_edited_items_are_found_and_others_left(spark, data_dir):
    dice = random.Random(6)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    rows, wanted = [], set()
    for i, text in items:
        budget = int(len(plain(text)) * 0.08) - 2
        letters = list(text)
        for _ in range(max(budget, 0)):
            letters[dice.randrange(len(letters))] = dice.choice("xyz")
        rows.append((i, "Before it. " + "".join(letters).replace("\n", " -- ") + " After it.", None, None, None))
        wanted.add(i)
        rows.append((1000 + i, text[: len(text) // 2], None, None, None))
    rows.append((2000, LONG + items[0][1] + LONG, None, None, None))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs(spark, rows), benchmark).collect()
    own = {r.doc_id for r in found if r.doc_id == r.item_id}
    assert own == wanted and {r.doc_id for r in found if r.doc_id >= 1000} == {2000}


def test_odd_rows(spark):
    rows = crowded(docs(spark), "matches", "item_id")
    items = [(None, "NOBODY's row!"), (1, None), (2, ""), (3, "shorts"), (4, "The same text TWICE, the same"), (5, "the same text twice the same")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(rows, benchmark).collect()
    wanted = [(d, i) for d in (6, 6, 7) for i in (4, 5)]
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == sorted([(None, None), *wanted], key=str)
    clean = decontaminate.decontaminated(rows, benchmark)
    assert clean.columns == rows.columns and clean.where("matches <> 'mine'").count() == 0 and clean.count() == 6
    for empty in (benchmark.limit(0), benchmark.where("item_id < 3")):
        assert decontaminate.decontaminated(rows, empty).count() == rows.count()
    assert decontaminate.contaminated(docs(spark, []), benchmark).count() == 0
    assert decontaminate.with_matches(docs(spark), benchmark).agg(F.sum(F.size("matches"))).first()[0] == 7


def test_short_items_are_found_as_whole_words(spark):
    texts = {1: "He asked: what is 2 plus 2? Nobody knew.", 2: "what is 2 plus 22", 3: "somewhat is 2 plus 2", 4: "WHAT IS 2, PLUS 2", 5: "2 plus",
             6: "a cat", 7: "concatenate", 8: "Cat!", 9: "x" * 30 + " cat", 10: "c at", 11: "a b c d e f g h i j", 12: "", 13: "cat"}
    items = [(1, "what is 2 plus 2?"), (2, "cat"), (3, "2"), (4, "b c d e f"), (5, "?!"), (6, "cat")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs(spark, [(i, t, None, None, None) for i, t in texts.items()]), benchmark).collect()
    wanted = {
        (d, i) for d, t in texts.items() for i, x in items
        if plain(x) and f" {plain(x)} " in f" {plain(t)} "
    }
    assert {(r.doc_id, r.item_id) for r in found} == wanted and {r.edits for r in found} == {0} and (1, 1) in wanted


def test_blocks_of_the_benchmark_are_searched_some_at_a_time(spark, data_dir, monkeypatch):
    benchmark = spark.read.parquet(f"{data_dir}/benchmark.parquet")
    table = spark.read.parquet(f"{data_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    whole = sorted(tuple(r) for r in decontaminate.contaminated(table, benchmark).collect())
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0]
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", -(-chars // 7))
    monkeypatch.setattr(decontaminate, "TOGETHER", 2)
    parts = decontaminate.contaminated(table, benchmark)
    assert parts._jdf.queryExecution().analyzed().toString().count("search(") <= 2 * 4
    assert sorted(tuple(r) for r in parts.collect()) == whole and whole


def test_recall_of_cut_and_edited_items(spark, data_dir):
    """What the edit budget means: nearly all within it are found, and few beyond."""
    dice = random.Random(12)
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    rows, kinds = [], {}
    for i, text in items:
        for kind, kept in (("cut to 95 %", 0.95), ("cut to 90 %", 0.90), ("cut to 50 %", 0.5)):
            kinds[len(rows)] = (kind, i)
            rows.append((len(rows), f"before it {text[: round(len(text) * kept)]} after it", None, None, None))
        for kind, share in (("5 % edited", 0.05), ("15 % edited", 0.15)):
            letters = list(text)
            for p in dice.sample(range(len(letters)), int(len(letters) * share)):
                letters[p] = "q" if letters[p] != "q" else "z"
            kinds[len(rows)] = (kind, i)
            rows.append((len(rows), f"before it {''.join(letters)} after it", None, None, None))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), benchmark).collect()}
    recall = {k: sum((d, i) in found for d, (kind, i) in kinds.items() if kind == k) / len(items) for k, _ in kinds.values()}
    assert recall["cut to 95 %"] > 0.95 and recall["5 % edited"] > 0.95
    assert recall["cut to 50 %"] == 0 and recall["15 % edited"] < 0.1, recall
