from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from farekit.llm import mixing, queries
from tests import oracle
from tests.llm.cases import crowded, docs


def filled(sizes, weights, share=1.5, most=2.0):
    """Reshare the excess by weight until no target is above its limit."""
    total, full = sum(sizes) * share, set()
    while True:
        rest = total - sum(sizes[i] * most for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if rest * weights[i] / weight > sizes[i] * most]
        if not over:
            return [sizes[i] * most if i in full else rest * weights[i] / weight for i in range(len(sizes))]
        full |= set(over)


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_the_fixed_point(spark, seed):
    dice = random.Random(seed)
    names = [f"s{i:02d}" for i in range(7)]
    sizes = [dice.choice([1, 5, 40, 300, 9000]) for _ in names]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(df).collect()}
    wanted = filled(sizes, [(3, 1, 2)[i % 3] for i in range(7)])
    assert [found[n] for n in names] == pytest.approx(wanted)
    assert sum(wanted) == pytest.approx(1.5 * sum(sizes))


def test_odd_rows_and_clashing_names(spark):
    rows = crowded(docs(spark), "size", "target", "copies", "__copy_of")
    found = mixing.with_copies(rows)
    assert found.count() == rows.count() and dict(found.dtypes)["size"] == "bigint"
    assert found.where("size * copies > 2 * size OR copies IS NULL").count() == 0
    assert found.where("source IS NULL").select("target").distinct().count() == 1
    mixed = mixing.mix(rows)
    assert mixed.columns == rows.columns and mixed.where("size <> 'mine'").count() == 0
    assert mixed.count() == found.agg(F.sum("copies")).first()[0]
    assert mixing.with_copies(docs(spark, [])).count() == mixing.mix(docs(spark, [])).count() == 0


def test_reruns_agree_and_sources_come_near_their_targets(spark, data_dir):
    path = data_dir.replace("sf0.001", "sf0.1")
    rows = queries.QUERIES["op5_mix_sources"](spark, path).join(
        spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "source"), "doc_id"
    )
    for r in rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.15)
    docs_ = spark.read.parquet(f"{data_dir}/documents.parquet")
    again = [sorted(mixing.mix(d).select("doc_id").collect()) for d in (docs_, docs_.repartition(7))]
    assert again[0] == again[1]


def test_query_agrees_with_sql(spark, data_dir):
    df = queries.QUERIES["op5_mix_sources"](spark, data_dir)
    assert oracle.compare(df, oracle.connect(data_dir), queries.ORACLES["op5_mix_sources"]) == []
