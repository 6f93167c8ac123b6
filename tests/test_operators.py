"""Table operators against brute force on small fixtures."""

from __future__ import annotations

import bisect
import random
import statistics
from datetime import date
from decimal import Decimal
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from farekit.operators import baseline, encode, lookup, popularity, pricing, profile
from farekit.session import scratch_path, scratch_scope, shared_dir, stage
from farekit.sources import dims, fixtures, readers, sinks


def median_of(spark, values, kind="double"):
    return profile.median(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v").first()[0]


@pytest.mark.parametrize("size", [1, 2, 101, 500])
def test_median_of_spread_values(spark, size):
    values = [random.Random(size).uniform(0, 1000) for _ in range(size)]
    assert median_of(spark, values) == pytest.approx(statistics.median(values))


def test_median_with_a_hot_value_and_a_gap(spark):
    hot = [7.0] * 50 + [float(i) for i in range(100)]
    assert median_of(spark, hot) == statistics.median(hot)
    gap = [float(i) for i in range(50)] + [1e6 + i for i in range(50)]
    assert median_of(spark, gap) == statistics.median(gap)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-1000, 1000).map(float), min_size=1, max_size=60))
def test_median_of_any_values(spark, values):
    assert median_of(spark, values) == statistics.median(values)


def test_median_at_the_ends_of_its_types(spark):
    infinite = float("inf")
    assert median_of(spark, [float(i) for i in range(9)] + [infinite]) == 4.5
    assert median_of(spark, [infinite, infinite, 1.0]) == infinite
    assert median_of(spark, [1.6e308, 1.7e308]) == pytest.approx(1.65e308)
    assert median_of(spark, [2**53 + 1] * 3, "bigint") == 2**53 + 1
    assert median_of(spark, [2**53 + 1, 2**53 + 2], "bigint") == Decimal(2**53 + 1) + Decimal("0.5")
    cents = [Decimal("12345678901234567890123456.01"), Decimal("12345678901234567890123456.02")]
    assert median_of(spark, cents, "decimal(30,2)") == Decimal("12345678901234567890123456.015")
    assert str(median_of(spark, [date(2025, 1, 3), date(2025, 1, 1), date(2025, 1, 2)], "date")) == "2025-01-02"


def test_median_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (5.0,)], "v double")
    assert profile.median(df, "v").first()[0] == 3.0
    assert profile.median(df.where("v is null"), "v").first()[0] is None


def test_dropped_rows_are_counted(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (float("nan"), "c"), (2.0, None)], "v double, s string")
    kept, dropped = profile.without_incomplete(df, ["v", "s"])
    assert kept.collect() == [(1.0, "a")]
    assert dropped.report().first().asDict() == {"kept_rows": 1, "dropped_rows": 3}
    kept, dropped = profile.without_incomplete(df.where("v < 0"), ["v", "s"])
    assert kept.collect() == [] and dropped.report().first().asDict() == {"kept_rows": 0, "dropped_rows": 0}


def test_counting_dropped_rows_reads_the_files_once(spark, data_dir):
    rows = fixtures.table(spark, data_dir, "events").select("event_id", "value")
    kept, dropped = profile.without_incomplete(rows, ["value"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    kept.write.format("noop").mode("overwrite").save()
    counts = dropped.report().first()
    assert counts.kept_rows + counts.dropped_rows == rows.count() and counts.kept_rows == rows.where("value IS NOT NULL").count()


def test_sets_of_keys_equal_one_grouping_each(spark):
    rows = [("f", 1, "E", 10.0), ("f", 1, "B", 30.0), ("g", 2, None, 8.0), (None, 2, "E", None), (None, None, None, 4.0)]
    df = spark.createDataFrame(rows, "flight string, days_left int, classx string, price double")
    sets = {"all": [], "class": ["classx"], "both": ["flight", "days_left"], "days": ["days_left"]}
    table = profile.stats_by_sets(df, "price", sets)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 1
    for name, keys in sets.items():
        got = table.where(F.col("part") == name).select(*keys, "avg_price", "min_price", "max_price", "count").collect()
        assert sorted(map(str, got)) == sorted(map(str, profile.stats_by(df, "price", keys).collect())), name
    assert profile.stats_by_sets(df.limit(0), "price", {"class": ["classx"]}).count() == 0
    assert profile.stats_by_sets(df, "price", {"all": []}).first()["count"] == 4
    with pytest.raises(ValueError, match="same keys"):
        profile.stats_by_sets(df, "price", {"a": ["classx"], "b": ["classx"]})


def test_report_equals_its_parts_taken_one_by_one(spark):
    rows = [("a", "Economy", "r1", "2025-01-04", 10.0), ("a", "Business", "r1", "2025-01-05", 30.0), ("b", "Economy", None, "2025-01-04", None),
            (None, None, "r2", None, 7.0), ("b", "Economy", "r2", "2025-01-06", 30.0)]
    df = spark.createDataFrame(rows, "airline string, class string, route string, date string, price double").withColumn("date", F.to_date("date"))
    holidays = spark.createDataFrame([("2025-01-06", "H")], "date string, holiday string").withColumn("date", F.to_date("date"))
    for table in (df, df.limit(0)):
        found = profile.Report.of(table, 365)
        assert found.summary().collect() == profile.summary(table, 365).collect()
        assert found.median_price().collect() == profile.median(table, "price").collect()
        for column in ("airline", "class"):
            assert sorted(map(str, found.shares(column).collect())) == sorted(map(str, profile.value_shares(table, column).collect()))
        assert found.top_routes(2).collect() == profile.top_values(table, "route", 2).collect()
        dated = table.where("date IS NOT NULL").join(holidays, "date", "left")
        assert found.busiest_days(holidays, 2).collect() == profile.busiest_days(dated, 2).collect()
    economy = profile.Report.of(df, 365).prices().first()
    assert (economy.economy_mean, economy.business_mean, economy.max_price) == (20.0, 30.0, 30.0)


@pytest.mark.parametrize("shape", ["uniform", "skewed", "tied", "odd"])
def test_approximate_median_is_near_the_middle_rank(spark, shape):
    x = {"uniform": F.rand(3), "skewed": F.exp(F.randn(4) * 5), "tied": F.floor(F.rand(5) * 4).cast("double"),
         "odd": F.when(F.col("id") % 7 == 0, float("inf")).when(F.col("id") % 7 == 1, float("-inf"))
                .when(F.col("id") % 7 == 2, float("nan")).when(F.col("id") % 7 == 3, None).otherwise(F.col("id").cast("double"))}[shape]
    df = spark.range(0, 60_000, 1, 6).select((F.col("id") % 3).alias("g"), x.alias("v")).cache()
    error = 0.005
    for keys in ([], ["g"]):
        for row in profile.approximate_median(df, "v", keys, error).collect():
            mine = df.where(F.col("g") == row.g) if keys else df
            values = sorted(r.v for r in mine.where("v IS NOT NULL AND NOT isnan(v)").collect())
            low, high = bisect.bisect_left(values, row["median"]), bisect.bisect_right(values, row["median"])
            assert low < high and low - error * len(values) <= len(values) / 2 <= high + error * len(values)
    df.unpersist()
    assert profile.approximate_median(df.where("v IS NULL"), "v").first()[0] is None
    with pytest.raises(ValueError, match="share"):
        profile.approximate_median(df, "v", rank_error=0)


def test_a_million_labels_are_ranked_in_ranges(spark):
    labels = spark.range(0, 1_000_000, 1, 8).select(F.concat(F.lit("l"), "id").alias("label"), (F.col("id") % 2).cast("string").alias("bit"))
    table = encode.index_table(labels.union(labels.where("label IN ('l7', 'l900000')")), ["label", "bit"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "[feature" in plan and all("part" in line for line in plan.splitlines() if "row_number" in line and "Window" in line)
    found = table.where("feature = 'label'").agg(
        F.count("*").alias("n"), F.count_distinct("index").alias("different"), F.max("index").alias("last")
    ).first()
    assert tuple(found) == (1_000_000, 1_000_000, 999_999)
    first = {r.label: r["index"] for r in table.where("feature = 'label' AND index < 4").collect()}
    assert first == {"l7": 0, "l900000": 1, "l0": 2, "l1": 3}
    # l7 is odd and l900000 even, so both bits are as frequent: the smaller label comes first.
    assert {r.label: r["index"] for r in table.where("feature = 'bit'").collect()} == {"0": 0, "1": 1}


def test_other_months_are_not_opened(spark, tmp_path):
    rows = spark.createDataFrame(
        [(i, f"2025-{1 + i % 12:02d}-{1 + i % 28:02d}") for i in range(500)] + [(-1, None)], "id long, date string"
    ).withColumn("date", F.to_date("date"))
    sinks.write_by_month(rows, str(tmp_path / "copy"))
    found = readers.read_by_month(spark, str(tmp_path / "copy"), "2025-03-10", "2025-05-02")
    plan = found._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "2025-03-01" in line.split("PartitionFilters")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(date,2025-03-10)" in line
    wanted = rows.where("date BETWEEN DATE '2025-03-10' AND DATE '2025-05-02'")
    assert found.columns == rows.columns and sorted(found.collect()) == sorted(wanted.collect()) and found.count()
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 501


def test_baseline_join_loses_exactly_the_flights_without_a_one_day_quote(spark, data_dir):
    quotes = fixtures.quotes(spark, data_dir, "fare_key")
    known = quotes.where("days_left = 1").select("flight").distinct()
    lost = quotes.join(known, "flight", "left_anti").count()
    assert lost > 0
    assert baseline.with_baseline(quotes).count() == quotes.count() - lost


def test_baseline_pools_classes_unless_asked(spark):
    quotes = spark.createDataFrame(
        [("f", 1, "Economy", 10.0), ("f", 1, "Business", 30.0), ("f", 5, "Economy", 8.0), ("g", 5, "Economy", 1.0)],
        "flight string, days_left int, classx string, price double",
    )
    ratios = {(r.days_left, r.classx): r.price_ratio for r in baseline.with_ratio(quotes).collect()}
    assert ratios == {(1, "Economy"): 0.5, (1, "Business"): 1.5, (5, "Economy"): 0.4}
    by_class = {(r.days_left, r.classx): r.price_ratio for r in baseline.with_ratio(quotes, by_class=True).collect()}
    assert by_class == {(1, "Economy"): 1.0, (1, "Business"): 1.0, (5, "Economy"): 0.8}


def test_popularity_falls_back_for_unknown_routes(spark):
    known = popularity.popularity_table(spark.createDataFrame([("A-B",)] * 4 + [("B-A",)] * 2, "route string"))
    asked = spark.createDataFrame([("A-B",), ("B-A",), ("X-Y",)], "route string")
    found = popularity.add_popularity(asked, known, fallback=True).collect()
    assert {(r.route, r.route_frequency, r.route_popularity_score) for r in found} == {
        ("A-B", 4, 1.0), ("B-A", 2, 0.5), ("X-Y", 100, 0.5),
    }


def test_distance_is_direction_free_with_a_default(spark):
    asked = spark.createDataFrame([("Delhi", "Mumbai"), ("Mumbai", "Delhi"), ("Goa", "Pune")], "a string, b string")
    found = lookup.distance_between(asked, dims.distances(spark), F.col("a"), F.col("b"))
    assert {(r.a, r.lookup_km) for r in found.collect()} == {("Delhi", 1150.0), ("Mumbai", 1150.0), ("Goa", 1000.0)}


def test_semi_and_anti_join_split_all_rows(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    words = spark.createDataFrame([("a",)], "value string")
    assert lookup.known_only(rows, words, "k").count() == 2
    assert lookup.unknown_only(rows, words, "k").count() == 2


def test_split_is_stable_and_whole(spark, data_dir):
    rows = fixtures.fares(spark, data_dir, "fare_key")
    train, held_out = encode.split(rows, F.col("fare_key"))
    again, _ = encode.split(rows.repartition(7), F.col("fare_key"))
    assert train.count() + held_out.count() == rows.count()
    assert sorted(train.collect()) == sorted(again.collect())
    assert 0.75 < train.count() / rows.count() < 0.85


@pytest.mark.parametrize("size", [1, 3, 200])
def test_split_falls_back_only_when_asked(spark, size):
    rows = spark.range(size).select(F.col("id").cast("string").alias("k"))
    train, held_out, percent = encode.split_with_fallback(rows, F.col("k"))
    assert percent == 90 and train.count() + held_out.count() == size
    train, held_out, percent = encode.split_with_fallback(rows, F.col("k"), fallback=True)
    if percent == 100:
        assert train.count() == held_out.count() == size
    else:
        assert held_out.count() >= 2 and train.count() + held_out.count() == size


def test_metrics_agree_with_the_evaluator(spark, data_dir):
    rows = fixtures.priced_fares(spark, data_dir).select(F.col("composed_price").cast("double").alias("y"), "rule_price")
    ours = encode.regression_metrics(rows, "y", "rule_price").first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="rule_price", metricName=name).evaluate(rows)
        assert ours[name] == pytest.approx(theirs, rel=1e-9)


def test_scenario_grid_has_every_combination_once(spark):
    bases = spark.createDataFrame([("f",), ("g",)], "flight string")
    grid = baseline.scenario_grid(bases, [1, 5, 10, 20], ["Economy", "Business"])
    assert grid.count() == grid.distinct().count() == 16


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_staged_table_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    staged = stage(df, "test")
    assert staged.schema == df.schema
    assert sorted(staged.collect()) == sorted(df.collect())
    assert stage(df.where("n > 5"), "test").count() == 0


def test_routes_are_keyed_by_id_not_by_pair(spark):
    routes = dims.routes(spark)
    assert routes.count() == 108
    assert routes.select("source_city", "destination_city").distinct().count() == 99
    flights = spark.createDataFrame([(1,), (100,), (999,)], "route_id int")
    found = {r.route_id: (r.route_km, r.route_multiplier) for r in pricing.add_route(flights, routes).collect()}
    assert found == {1: (None, 1.0), 100: (440, 1.1), 999: (None, None)}


def test_rows_without_a_key_still_belong_to_a_part(spark):
    rows = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    train, held_out = encode.split(rows, F.col("k"))
    assert train.count() + held_out.count() == 3


def test_what_a_job_stages_is_removed(spark):
    with scratch_scope(spark):
        table = stage(spark.range(3).toDF("n"), "passing")
        path = table.inputFiles()[0]
        assert table.count() == 3
    kept = stage(spark.range(3).toDF("n"), "kept")
    with pytest.raises(Exception, match="(?i)not exist|no such|not.found"):
        spark.read.parquet(path).count()
    assert kept.count() == 3 and scratch_path(spark, "x").startswith(shared_dir(spark))


@pytest.mark.parametrize(("master", "refused"), [("local", False), ("local[4]", False), ("local-cluster[2,1,1024]", True), ("spark://host:7077", True)])
def test_a_cluster_must_name_its_shared_folder(master, refused):
    class Context:
        def __init__(self):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    def session(**settings):
        return SimpleNamespace(sparkContext=Context(), conf=SimpleNamespace(get=lambda name, *other: settings.get(name, *other)))

    alone = session(**{"spark.sql.warehouse.dir": "file:/work/warehouse"})
    if refused:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(alone)
    else:
        assert shared_dir(alone) == "file:/work/warehouse/_farekit"
    assert shared_dir(session(**{"spark.checkpoint.dir": "hdfs:/shared/"})) == "hdfs:/shared"
