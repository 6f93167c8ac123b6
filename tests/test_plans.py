"""Shapes of physical plans, and results under skew and without broadcasts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farekit.catalog import QUERIES
from farekit.operators import baseline, lookup, popularity
from farekit.session import stage
from farekit.sources import fixtures


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


FITTED = {"m05_gradient_boosting", "m06_random_forest", "m07_factorization_machine", "m08_stored_multiplier"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_cartesian_products_and_no_python_in_plans(spark, data_dir, name):
    plan = plan_of(QUERIES[name](spark, data_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_only_needed_tables_and_columns_are_read(spark, data_dir):
    plan = plan_of(fixtures.fares(spark, data_dir, "class", "price"))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in plan


def test_filters_reach_the_scan(spark, data_dir):
    dated = fixtures.fares(spark, data_dir, "date", "price").where("date >= DATE '2000-01-01' AND price > 5000")
    plan = plan_of(dated)
    assert "GreaterThanOrEqual(l_shipdate," in plan and "GreaterThan(l_extendedprice,5000.0)" in plan
    path = stage(fixtures.quotes(spark, data_dir), "quotes")
    assert "EqualTo(days_left,1)" in plan_of(baseline.baseline_prices(path))


@pytest.fixture
def no_broadcast_small_skew(spark):
    """Force sort-merge joins and let a few kilobytes count as a skewed partition."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_a_hot_route_is_split_and_keeps_all_rows(spark, no_broadcast_small_skew):
    # One route holds a third of the rows; the others hold a few each.
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 5000)).alias("route"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    scored = popularity.add_popularity(rows, popularity.popularity_table(rows))
    found = {r.hot: (r.n, r.low, r.high) for r in scored.groupBy((F.col("route") == "hot").alias("hot")).agg(
        F.count("*").alias("n"), F.min("route_popularity_score").alias("low"), F.max("route_popularity_score").alias("high")
    ).collect()}
    assert found[True] == (20_000, 1.0, 1.0)
    assert found[False][0] == 40_000
    ran = scored.select("route", "route_frequency", "payload")
    ran.write.format("noop").mode("overwrite").save()
    ran.collect()
    plan = plan_of(ran)
    assert "SortMergeJoin" in plan
    assert "isSkew=true" in plan or "skew=true" in plan.lower()


def test_results_do_not_depend_on_broadcasting(spark, data_dir, no_broadcast_small_skew):
    quotes = fixtures.quotes(spark, data_dir, "fare_key")
    big = baseline.with_ratio(quotes).select("fare_key", F.round("price_ratio", 9)).collect()
    words = stage(quotes.select("flight").distinct().where("flight > 'NATION_2'"), "words")
    known = lookup.known_only(quotes, words, "flight").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    small = baseline.with_ratio(quotes).select("fare_key", F.round("price_ratio", 9)).collect()
    assert sorted(big) == sorted(small)
    assert lookup.known_only(quotes, words, "flight").count() == known
