from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pytest

from farekit.llm import audit, queries
from tests import oracle
from tests.llm.cases import ODD, crowded, docs

LABELS = "doc_id long, quality int, toxic int"


def brute_masks(rows):
    """(doc_id, part, letters failed) of every row."""
    out = []
    for doc_id, text, _, source, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 50:
            failed.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            failed.add("C")
        if re.search(r"[#$%&*|]", text):
            failed.add("D")
        twins = [r[0] for r in rows if (r[1] or "") == text and r[0] is not None]
        if twins and (doc_id is None or doc_id > min(twins)):
            failed.add("E")
        out.append((doc_id, source or "", failed))
    return out


def brute(rows, labels):
    """Every order applied to every document, one after the other."""
    good = {r[0] for r in labels if r[1] == 1 and r[0] is not None}
    toxic = {r[0] for r in labels if r[2] == 1 and r[0] is not None}
    masks = brute_masks(rows)
    found, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {p for _, p, _ in masks}:
            left = [m for m in masks if m[1] == part]
            mine = list(left)
            for step, name in enumerate(order, 1):
                gone = [m for m in left if name in m[2]]
                left = [m for m in left if name not in m[2]]
                found[part, order, step] = (
                    len(left), len(gone), sum(name in m[2] for m in mine) - len(gone), sum(m[2] == {name} for m in mine),
                    sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone),
                )
                shapley[part, name] += len(gone)
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in found.items()}


COLUMNS = (
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
)


def rows_of(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_intervals_hold_the_orders_in_which_a_mask_goes():
    names = audit.orders()
    assert names == sorted(names) and len(set(names)) == 120
    assert [audit.lehmer_rank(o) for o in names] == list(range(120))
    for mask in range(1, 32):
        seen = {}
        for m, step, name, begin, end in audit.removal_intervals():
            if m == mask:
                for rank in range(begin, end):
                    assert rank not in seen
                    seen[rank] = (step, name)
        failing = {f for i, f in enumerate("ABCDE") if mask >> i & 1}
        for rank, order in enumerate(names):
            step = next(i for i, f in enumerate(order, 1) if f in failing)
            assert seen[rank] == (step, order[step - 1])


def test_equals_every_order_applied_in_turn(spark):
    rows = [*ODD, (8, "SHOUT " * 60, "en", "", 1), (9, " ".join(map(str, range(60))) + " #", "en", "b", 1), (10, "A", "en", "a", 1)]
    labels = [(4, 1, 0), (4, 0, 1), (6, 1, None), (8, None, 1), (None, 1, 1), (7, 1, 1), (99, 1, 1), (5, 2, 2)]
    found = audit.interactions(crowded(docs(spark, rows), "mask", "part", "digest", "rank"), spark.createDataFrame(labels, LABELS))
    assert rows_of(found) == brute(rows, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit.interactions(docs(spark, []), none).count() == 0
    assert rows_of(audit.interactions(docs(spark), none)) == brute(ODD, [])


def test_query_agrees_with_sql_and_brute_force(spark, data_dir):
    df = queries.QUERIES["op11_filter_interactions"](spark, data_dir)
    assert oracle.compare(df, oracle.connect(data_dir), queries.ORACLES["op11_filter_interactions"]) == []
    table = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{data_dir}/{name}.parquet").select(*columns).collect()]
    rows = table("documents", "doc_id", "text", "lang", "source")
    assert rows_of(df) == brute(rows, table("labels", "doc_id", "quality", "toxic"))


@pytest.mark.parametrize("share", [0.34, 1.0])
def test_copies_of_a_hot_text_fail_but_for_the_first(spark, share):
    rows = [(i, "the same line" if i < 3000 * share else f"text {i}", "en", "hot" if i % 3 else None, 1) for i in range(3000)]
    masks = audit.with_masks(docs(spark, rows))
    copies = sum(r[1] == "the same line" for r in rows) - 1
    assert masks.where("mask >= 16").count() == copies
