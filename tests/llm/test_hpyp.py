from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from farekit.llm import hpyp, queries
from farekit.llm.spans import SpanHasher
from tests.llm.cases import ODD, crowded, docs


def brute_tokens(text):
    lowered = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    return [*re.findall(rb"[^\x20\x09-\x0D]+", lowered), None]


def test_hashes_tell_words_apart_wherever_they_stand():
    hasher, data = SpanHasher(), b"word other word wor d\nword"
    array = np.frombuffer(data, dtype=np.uint8)
    spans = [(m.start(), m.end()) for m in re.finditer(rb"\S+", data)]
    found = hasher.hashes(array, *(np.array(x) for x in zip(*spans, strict=True)))
    assert len({*found.tolist()}) == 4 and found[0] == found[2] == found[5]


def test_tables_follow_the_restaurant():
    """Two and three customers: the mean number of tables against every seating."""
    rng, discount = np.random.default_rng(1), 0.8
    for fresh in (0.05, 0.7, 6.0):
        # Two: a second table weighs fresh, the first 1 - discount.
        tables, last = hpyp.seat(np.full(20_000, 2), np.full(20_000, fresh), discount, rng, 6)
        assert tables.mean() == pytest.approx(1 + fresh / (fresh + 1 - discount), abs=0.02)
        assert set(last.tolist()) <= {1, 2}
        # Three: weights of one table, of the three splits in two, and of three tables.
        one, two, three = (1 - discount) * (2 - discount), 3 * fresh * (1 - discount), fresh * fresh
        tables, _ = hpyp.seat(np.full(20_000, 3), np.full(20_000, fresh), discount, rng, 10)
        assert tables.mean() == pytest.approx((one + 2 * two + 3 * three) / (one + two + three), abs=0.03)
    tables, last = hpyp.seat(np.array([0, 1, 5000]), np.array([1.0, 1.0, 3.0]), discount, rng)
    assert tables[:2].tolist() == last[:2].tolist() == [0, 1] and 1 <= tables[2] <= 5000


def exact_mean(customers, fresh, discount):
    """The mean number of tables by whole numbers of seatings: weights of t tables, one customer after the other."""
    weights = [Fraction(0), Fraction(1)]
    d, w = Fraction(discount).limit_denominator(1000), Fraction(fresh).limit_denominator(1000)
    for c in range(1, customers):
        old = [*weights, Fraction(0)]
        weights = [Fraction(0)] + [old[t - 1] + (c - d * t) * old[t] for t in range(1, c + 2)]
    terms = [w**t * x for t, x in enumerate(weights)]
    return float(sum(t * x for t, x in enumerate(terms)) / sum(terms))


@pytest.mark.parametrize(("customers", "tabled"), [(4, 1024), (20, 1024), (100, 1024), (400, 1024), (400, 10)])
def test_the_number_of_tables_follows_its_exact_law(monkeypatch, customers, tabled):
    """Also by the way for more than a thousand customers, on fewer."""
    monkeypatch.setattr(hpyp, "TABLED", tabled)
    rng = np.random.default_rng(2)
    for fresh in (0.05, 1.0, 5.0, 50.0):
        for discount in (0.8, 0.6):
            tables, last = hpyp.seat(np.full(4000, customers), np.full(4000, fresh), discount, rng, 8)
            exact = exact_mean(customers, fresh, discount)
            assert tables.mean() == pytest.approx(exact, rel=0.03), (fresh, discount)
            assert 1 <= last.min() and last.max() <= customers


def test_the_law_for_many_customers_continues_the_tabled_one():
    for discount in (0.8, 0.6, 0.5):
        table = hpyp._log_partitions(1500, discount)[1500]
        t = np.concatenate([np.arange(1, 40), np.arange(40, 1400, 17)])
        off = hpyp._log_many(1500, t, discount) - table[t]
        # Up to a term of the number of customers alone.
        assert np.abs(off - off[-1]).max() < 0.015


def test_many_customers_cost_no_more_and_stay_in_the_law():
    """Large numbers: the mean of the saddle point's law near that of the tilted one, also where most tables are single."""
    rng = np.random.default_rng(3)
    for customers, fresh in ((10**5, 5.0), (10**7, 300.0), (10**7, 1e-6), (5000, 1e6), (10**9, 1e4)):
        tables, last = hpyp.seat(np.full(20, customers), np.full(20, fresh), 0.8, rng, 8)
        middle = hpyp._middle(np.array([float(customers)]), np.array([fresh]), 0.8)[0]
        assert abs(tables.mean() - middle) < 2 + 0.1 * middle and 1 <= last.min() <= last.max() <= customers


def test_base_and_counts_equal_brute_force(spark, data_dir):
    found = {r.doc_id: r for r in queries.QUERIES["op1_hpyp_score"](spark, data_dir).collect()}
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    taught = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in rows}
    counts = Counter(t for r in rows if taught[r.doc_id] for t in brute_tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    for r in rows:
        tokens, got = brute_tokens(r.text), found[r.doc_id]
        assert (got.held_out, got.n_tokens, got.train_tokens) == (not taught[r.doc_id], len(tokens), n)
        assert got.n_known == sum(counts[t] > 0 for t in tokens)
        assert got.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_all_texts_add_up_to_one(spark):
    """Three words and an unknown one: the texts of up to seven words have nearly all of the probability, never more."""
    taught = [(i, t, None, None, None) for i, t in enumerate(["a", "b a", "a b", "", "b", "a a", "c", "a b"] * 5)]
    texts = [" ".join(p) for n in range(6) for p in itertools.product("abcz", repeat=n)]
    rows = taught + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)]
    scored = hpyp.score_texts(docs(spark, rows), F.col("doc_id") < 1000)
    total = scored.where("doc_id >= 1000").agg(F.sum(F.pow(F.lit(10.0), "score"))).first()[0]
    assert 0.98 < total <= 1 + 1e-6


def test_odd_rows(spark):
    scored = hpyp.score_texts(crowded(docs(spark), "body", "n_tokens"), F.col("doc_id") != 5)
    rows = scored.collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert {r.in_training for r in rows if r.doc_id is None} == {False}
    assert hpyp.score_texts(docs(spark, []), F.lit(True)).count() == 0
    nothing = hpyp.score_texts(docs(spark), F.lit(False)).first()
    assert (nothing.train_tokens, nothing.n_known, nothing.base_score) == (0, 0, 0) and nothing.score == pytest.approx(0)


def test_reruns_agree(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet")
    first, second = (
        dict(hpyp.score_texts(d, F.col("doc_id") % 3 > 0).select("doc_id", "score").collect()) for d in (rows, rows.repartition(3))
    )
    assert first == pytest.approx(second, abs=1e-3)


def test_scores_do_not_depend_on_the_number_of_buckets(spark):
    """One word makes up two thirds of a text; its bucket's sums are far from the mean."""
    dice = np.random.default_rng(4)
    texts = [" ".join("hot" if x < 4 else f"w{y}" for x, y in zip(dice.integers(0, 6, 80), dice.zipf(1.3, 80) % 900)) for _ in range(80)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (1, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            scored = hpyp.score_texts(docs(spark, rows), F.col("doc_id") % 4 > 0).where("doc_id % 4 = 0")
            found.append(np.array([r.score for r in scored.orderBy("doc_id").collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert abs(found[1].sum() / found[0].sum() - 1) < 0.003


def test_the_plan_stays_small(spark):
    """Grouped Python steps in the logical plan: one mention of the totals a turn, none of them in the result's columns."""
    nodes = []
    for rounds in (1, 2, 3):
        plan = hpyp.score_texts(docs(spark), F.lit(True), rounds=rounds)._jdf.queryExecution().analyzed().toString()
        nodes.append(plan.count("FlatMapGroupsInArrow") + plan.count("FlatMapCoGroupsInArrow"))
    assert nodes[1] < 60 and nodes[2] < 2.5 * nodes[1], nodes
