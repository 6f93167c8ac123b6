"""Invariants of the fitted models."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from farekit import session
from farekit.catalog import inputs
from farekit.operators import encode, popularity
from farekit.plans import features, multiplier, training
from farekit.session import scratch_path
from farekit.sources import readers, sinks


@pytest.fixture(scope="module")
def fit(spark, data_dir):
    return inputs.fare_fit(spark, data_dir)


def test_vector_width_is_labels_plus_numbers(fit):
    labels = sum(fit.train.select(c).distinct().count() for c in features.CATEGORICAL)
    vector = fit.model.transform(fit.train).select(F.size(vector_to_array("features"))).first()[0]
    assert vector == labels + len(features.NUMERIC) == fit.model.stages[-1].numFeatures


def test_unknown_label_gives_a_zero_block(fit):
    odd = fit.held_out.limit(5).withColumn("airline", F.lit("never seen"))
    blocks = fit.model.transform(odd).select(vector_to_array("airline_encoded").alias("block")).collect()
    assert len(blocks) == 5 and all(set(row.block) == {0.0} for row in blocks)


def test_importances_name_every_slot_and_sum_to_one(fit):
    slots = training.importances(fit.model, fit.train)
    assert slots.count() == fit.model.stages[-1].numFeatures
    assert slots.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    sources = {r.source for r in training.importance_by_source(slots).collect()}
    assert sources == {*features.CATEGORICAL, *features.NUMERIC}
    top = [r.importance for r in training.top_importances(slots, 10).collect()]
    assert len(top) == 10 and top == sorted(top, reverse=True)


def test_scaled_vector_matches_the_table_form(fit):
    column = "distance_km"
    raw = fit.model.transform(fit.train)
    slot = {r.feature: r.slot for r in training.slot_names(raw).collect()}[column]
    by_table = encode.scaled(raw, [column]).select(
        F.max(F.abs(F.col(f"{column}_scaled") - vector_to_array("features")[slot]))
    )
    assert by_table.first()[0] < 1e-9


def test_index_table_matches_the_fitted_indexer(fit):
    table = encode.index_table(fit.train, list(features.CATEGORICAL)).collect()
    ours = {(r.feature, r.label): r["index"] for r in table}
    indexer = fit.model.stages[0]
    for feature, labels in zip(features.CATEGORICAL, indexer.labelsArray, strict=True):
        assert [ours[feature, label] for label in labels] == list(range(len(labels)))


def test_saved_model_predicts_the_same(spark, fit):
    path = scratch_path(spark, "saved")
    sinks.save_model(fit.model, path)
    sinks.save_model(fit.model, path)  # overwrites
    one = fit.model.transform(fit.held_out).select("fare_key", "predicted_price")
    two = readers.load_model(path).transform(fit.held_out).select("fare_key", "predicted_price")
    assert sorted(one.collect()) == sorted(two.collect())


def test_held_out_quality(fit):
    assert fit.r2 > 0.7


def test_training_popularity_ignores_held_out_rows(fit):
    assert fit.popularity.agg(F.sum("route_frequency")).first()[0] == fit.train.count()
    assert popularity.route_counts(fit.train).count() == fit.popularity.count()


def test_presets_keep_their_parameters():
    gbt = training.fare_pipeline().getStages()[-1]
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSubsamplingRate()) == (100, 6, 0.1, 0.8)
    forest = training.fare_pipeline("rf").getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (100, 10, 5)
    machine = multiplier.notebook_pipeline().getStages()[-1]
    assert (machine.getFactorSize(), machine.getRegParam(), machine.getMaxIter()) == (4, 0.1, 50)
    stored = multiplier.stored_pipeline().getStages()[-1]
    assert (stored.getFactorSize(), stored.getRegParam(), stored.getMaxIter(), stored.getStepSize()) == (8, 0.01, 100, 1.0)


def test_multiplier_stays_in_range(spark, data_dir):
    model, _, held_out = inputs.notebook_fit(spark, data_dir)
    scored = multiplier.score_multiplier(model, held_out.drop("class_numeric"))
    low, high = scored.agg(F.min("multiplier"), F.max("multiplier")).first()
    assert 0.3 <= low <= high <= 1.5
    priced = multiplier.price_scenarios(scored).first()
    assert priced.final_price == int(10000 * priced.multiplier)


def test_fits_pass_over_equal_parts_in_one_order(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7).alias("n"))
    seen = []
    for parts in (3, cores + 1):
        with session.even_parts(rows.repartition(parts)) as dealt:
            seen.append(dealt.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "key").collect())
            sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("part")).count().collect()]
        assert len(sizes) == cores and max(sizes) < 1.1 * 40_000 / cores and sum(sizes) == 40_000
    assert sorted(seen[0]) == sorted(seen[1])


def test_boosting_does_not_depend_on_how_its_rows_are_laid_out(spark, fit):
    scored = []
    for parts in (3, 7):
        model = training.fit_fare_model(fit.train.repartition(parts), "gbt", maxIter=3)
        scored.append(sorted(model.transform(fit.held_out).select("fare_key", F.round("predicted_price", 6)).collect()))
    assert scored[0] == scored[1]


def test_large_tables_take_several_turns(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_PART", 100)
    cores = spark.sparkContext.defaultParallelism
    with session.even_parts(spark.range(250 * cores)) as dealt:
        assert dealt.rdd.getNumPartitions() == 3 * cores and dealt.count() == 250 * cores


def _ratio_rows(spark, data_dir):
    rows, _, _ = multiplier.training_ratios(inputs.ratios(spark, data_dir), "fare_key")
    return rows.withColumn("price_multiplier", F.col("price_ratio"))


def _coefficients(model):
    machine = model.stages[-1]
    return np.concatenate([[machine.intercept], machine.linear.toArray(), machine.factors.toArray().ravel()])


@pytest.mark.parametrize("pipeline", [multiplier.notebook_pipeline, multiplier.stored_pipeline])
@pytest.mark.parametrize(
    "overrides", [{}, {"fitIntercept": False, "maxIter": 9}, {"fitLinear": False, "maxIter": 9}, {"tol": 0.1}, {"solver": "gd", "maxIter": 3}]
)
def test_machine_from_moments_is_the_one_from_rows(spark, data_dir, pipeline, overrides):
    rows = _ratio_rows(spark, data_dir)
    ours, theirs = multiplier.fit_machine(pipeline(**overrides), rows), pipeline(**overrides).fit(rows)
    assert _coefficients(ours) == pytest.approx(_coefficients(theirs), rel=1e-9, abs=1e-11)
    set_in = lambda m: {p.name: v for p, v in m.stages[-1].extractParamMap().items()}
    assert set_in(ours) == set_in(theirs)
    path = scratch_path(spark, "machine")
    sinks.save_model(ours, path)
    loaded = readers.load_model(path)
    assert (_coefficients(loaded) == _coefficients(ours)).all()
    prediction = ours.stages[-1].getPredictionCol()
    scored = [m.transform(rows).select("fare_key", prediction) for m in (loaded, theirs)]
    far = scored[0].join(scored[1].toDF("fare_key", "theirs"), "fare_key").agg(F.max(F.abs(F.col(prediction) - F.col("theirs"))))
    assert far.first()[0] < 1e-9


@pytest.mark.parametrize("fit_of", ["notebook_fit", "stored_fit"])
def test_machine_passes_over_its_rows_once(spark, data_dir, monkeypatch, fit_of):
    """Jobs of a fit do not grow with its steps; FMRegressor runs one in each."""
    monkeypatch.setattr(inputs, "_fits", {})
    group = f"jobs of {fit_of}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        model = getattr(inputs, fit_of)(spark, data_dir)[0]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < model.stages[-1].getMaxIter() - 10


def test_rows_that_the_library_refuses_are_refused(spark):
    for label, days in ((None, 2), (float("nan"), 2), (1.0, float("inf")), (1.0, None)):
        rows = spark.createDataFrame([(1.0, 0.0, 1.0), (float(days) if days else None, 1.0, label)], "days_left double, class_numeric double, price_ratio double")
        with pytest.raises(Exception):
            multiplier.notebook_pipeline(maxIter=2).fit(rows)
        with pytest.raises(Exception):
            multiplier.fit_machine(multiplier.notebook_pipeline(maxIter=2), rows)


def test_many_inputs_are_fitted_row_by_row(spark):
    rows = spark.range(200).selectExpr("CAST(id % 30 AS INT) days_left", "CONCAT('c', id % 9) classx", "id % 7 / 4.0D price_multiplier")
    ours, theirs = (f(multiplier.stored_pipeline(maxIter=4)) for f in (lambda p: multiplier.fit_machine(p, rows), lambda p: p.fit(rows)))
    assert ours.stages[-1].numFeatures > multiplier.MOMENT_INPUTS
    assert _coefficients(ours) == pytest.approx(_coefficients(theirs), rel=1e-9, abs=1e-11)


def test_quotes_take_their_names_from_the_staged_rows(spark, data_dir, fit, monkeypatch):
    """The tables are not joined again for the vocabularies, and names and roles are the same."""
    known = inputs.vocabularies(spark, data_dir)

    def refuse(*_):
        raise AssertionError("joined again")

    monkeypatch.setattr(inputs, "vocabularies", refuse)
    monkeypatch.setattr(inputs, "fare_fit", lambda *_: fit)
    names = inputs.quote_context(spark, data_dir).names
    for ours, theirs in ((names.airlines, known.airlines), (names.cities, known.cities)):
        assert sorted(ours.collect()) == sorted(theirs.collect())


def test_fits_are_not_scored_before_a_score_is_asked_for(spark, data_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(inputs, "once", lambda spark, key, make: make())
    monkeypatch.setattr(training, "fit_fare_model", lambda train, preset: None)
    monkeypatch.setattr(inputs.encode, "regression_metrics", lambda *_: asked.append(1))
    inputs.fare_fit(spark, data_dir)
    assert not asked
