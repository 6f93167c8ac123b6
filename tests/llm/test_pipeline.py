from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from farekit.llm import quality
from farekit.session import stage
from tests.llm.cases import ODD, crowded, docs
from tests.llm.test_decontaminate import plain
from tests.llm.test_mixing import filled
from tests.llm.test_sharding import check


@pytest.fixture(scope="module")
def steps(spark, data_dir):
    """The documents before and after every stage."""
    path = data_dir.replace("sf0.001", "sf0.01")
    tables = [spark.read.parquet(f"{path}/documents.parquet")]
    for name, function in corpus_pipeline.STAGES:
        tables.append(stage(function(spark, tables[-1], path), name))
    return path, tables


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_all_but_the_last_keep_the_columns(steps):
    _, tables = steps
    assert all(t.columns == tables[0].columns for t in tables[:-1])
    assert tables[-1].columns == [*tables[0].columns, "shard", "slot"]


def test_rules_take_what_fails_and_little_else(spark, steps):
    path, (before, after, *_) = steps
    failed = ids(quality.with_counts(before).where(quality.base_failed()))
    gone = ids(before) - ids(after)
    assert failed <= gone
    good = ids(spark.read.parquet(f"{path}/labels.parquet").where("quality = 1"))
    assert len((gone - failed) & good) <= 0.02 * len(good)


def test_no_text_stays_twice(steps):
    _, (_, before, after, *_) = steps
    assert after.count() == after.select("text").distinct().count() <= before.select("text").distinct().count()
    assert after.exceptAll(before).count() == 0


def test_no_leak_stays_and_no_clean_document_goes(spark, steps):
    path, (_, _, before, after, *_) = steps
    items = [plain(r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before.collect() if any(i in plain(r.text) for i in items)}
    assert leaks and ids(before) - ids(after) == leaks


def test_mix_repeats_up_to_twice(steps):
    _, (*_, before, after, _) = steps
    size = F.sum(F.size(F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')")))
    words = {r.source: r.n for r in before.groupBy("source").agg(size.alias("n")).collect()}
    taken = {r.source: r.n for r in after.groupBy("source").agg(size.alias("n")).collect()}
    names = sorted(words)
    targets = filled([words[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    assert sum(taken.values()) == pytest.approx(sum(targets), rel=0.1)
    assert max(r["count"] for r in after.groupBy("doc_id").count().collect()) <= 2


def test_shards_hold_every_row(steps):
    _, (*_, before, after) = steps
    assert after.drop("shard", "slot").exceptAll(before).count() == 0
    check(after, before.count(), 8)


def test_run_and_odd_rows(spark, data_dir, tmp_path):
    assert corpus_pipeline.run(spark, data_dir).count() > 0
    for rows in (ODD, []):
        docs(spark, rows).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{len(rows)}/documents.parquet")
        for name, kind in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
            spark.createDataFrame([], kind).write.mode("overwrite").parquet(f"{tmp_path}/{len(rows)}/{name}.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{len(rows)}").count() == 0
    for name, function in corpus_pipeline.STAGES[1:]:
        out = function(spark, crowded(docs(spark), "row", "part", "bits", "__size_"), f"{tmp_path}/0")
        assert {"row", "part", "bits", "__size_"} <= set(out.columns), name
