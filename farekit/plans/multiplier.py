"""The price-multiplier models and scenario pricing."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.regression import FMRegressionModel, FMRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farekit.functions import rules
from farekit.operators import encode
from farekit.session import stage_by_key

# The two multiplier presets.
NOTEBOOK = {"factorSize": 4, "fitIntercept": True, "fitLinear": True, "regParam": 0.1, "maxIter": 50, "stepSize": 0.1}
STORED = {
    "factorSize": 8,
    "fitIntercept": True,
    "fitLinear": True,
    "regParam": 0.01,
    "maxIter": 100,
    "stepSize": 1.0,
    "solver": "adamW",
}
MINI_BATCH = 1.0
# Inputs up to which the moments of the rows are summed: six have 253 moments and 22 sums with the label.
MOMENT_INPUTS = 6

# Scenarios priced with a fitted model.
SCENARIO_DAYS = [1, 5, 10, 20]
SCENARIO_CLASSES = ["Economy", "Business"]
SCENARIO_BASE = 10000


def numeric_class(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("class_numeric", rules.class_flag(F.col("classx")))


def notebook_pipeline(**overrides) -> Pipeline:
    """Lead time and class flag into a factorization machine; incomplete rows are an error."""
    assembler = VectorAssembler(
        inputCols=["days_left", "class_numeric"], outputCol="features", handleInvalid="error"
    )
    machine = FMRegressor(
        featuresCol="features",
        labelCol="price_ratio",
        predictionCol="predicted_ratio",
        miniBatchFraction=MINI_BATCH,
        **{**NOTEBOOK, **overrides},
    )
    return Pipeline(stages=[assembler, machine])


def stored_pipeline(**overrides) -> Pipeline:
    """Lead time and one-hot class into a factorization machine."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol="classx", outputCol="class_indexed"),
            OneHotEncoder(inputCol="class_indexed", outputCol="class_encoded"),
            VectorAssembler(inputCols=["days_left", "class_encoded"], outputCol="features"),
            FMRegressor(
                featuresCol="features",
                labelCol="price_multiplier",
                predictionCol="predicted_multiplier",
                miniBatchFraction=MINI_BATCH,
                **{**STORED, **overrides},
            ),
        ]
    )


def _moments(terms: list[Column], label: Column) -> list[Column]:
    """Rows, rows with a label, and the sums of all products of two terms and of each term with the label."""
    pairs = [F.sum(a * b).alias(f"m{i}_{j}") for i, a in enumerate(terms) for j, b in enumerate(terms[: i + 1])]
    labels = [F.sum(a * label).alias(f"y{i}") for i, a in enumerate(terms)]
    return [F.count("*").alias("n"), F.count(label).alias("labelled"), *pairs, *labels]


def _descend(machine: FMRegressor, start: FMRegressionModel, gram: np.ndarray, moment: np.ndarray) -> FMRegressionModel:
    """The steps of the machine's solver from its own start, on the mean moments of the rows.

    A factorization machine is linear in 1, its inputs and their products; the
    squared error of all rows, and so every step, depends on the rows by the
    moments of these terms alone.
    """
    factors, linear = start.factors.toArray(), start.linear.toArray()
    n = len(linear)
    upper = np.triu_indices(n, 1)
    weights = np.concatenate([factors.ravel(), linear, [start.intercept]])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    rate, decay = machine.getStepSize(), machine.getRegParam()
    for step in range(1, machine.getMaxIter() + 1):
        factors, linear, intercept = weights[: -n - 1].reshape(n, -1), weights[-n - 1 : -1], weights[-1]
        slope = 2 * (gram @ np.concatenate([[intercept], linear, (factors @ factors.T)[upper]]) - moment)
        between = np.zeros((n, n))
        between[upper] = slope[n + 1 :]
        parts = (between + between.T) @ factors, slope[1 : n + 1] * machine.getFitLinear(), slope[:1] * machine.getFitIntercept()
        gradient = np.concatenate([p.ravel() for p in parts])
        # AdamW with its usual constants; the decay is not scaled by the rate, as in the solver of that name.
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        before, weights = weights, weights - (rate * move + decay * weights)
        if step > 1 and np.linalg.norm(weights - before) < machine.getTol() * max(np.linalg.norm(weights), 1.0):
            break
    values = weights[: -n - 1].reshape(n, -1)
    matrix = DenseMatrix(n, values.shape[1], values.ravel(order="F").tolist())
    fitted = FMRegressionModel._create_from_java_class(
        "org.apache.spark.ml.regression.FMRegressionModel",
        machine.uid, float(weights[-1]), Vectors.dense(weights[-n - 1 : -1]), matrix,
    )
    return machine._copyValues(fitted)


def fit_machine(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """Fit a pipeline that ends in a factorization machine with one pass over the rows, whatever its number of steps.

    ``FMRegressor`` passes over all rows in every step. Its steps over whole
    batches need the moments of the rows only, which one aggregation gives, so
    the steps cost the same for any table. The model is that of ``FMRegressor``
    but for rounding. It fits itself where this does not hold: other solvers, parts of
    batches, more than ``MOMENT_INPUTS`` inputs, or rows that it refuses.
    """
    *before, machine = pipeline.getStages()
    prepared = Pipeline(stages=before).fit(rows)
    table = prepared.transform(rows)
    whole = machine.getSolver() == "adamW" and machine.getMiniBatchFraction() == 1.0
    one = table.limit(1)
    if not whole or one.isEmpty():
        return PipelineModel([*prepared.stages, machine.fit(table)])
    # No step taken: the start, which depends on the seed and the number of inputs alone.
    start = machine.copy({machine.maxIter: 0}).fit(one)
    n = start.numFeatures
    if n > MOMENT_INPUTS:
        return PipelineModel([*prepared.stages, machine.fit(table)])
    inputs = vector_to_array(F.col(machine.getFeaturesCol()))
    label = F.col(machine.getLabelCol()).cast("double")
    named = table.select(inputs.alias("x"), label.alias("y"))
    x = [F.get("x", F.lit(i)) for i in range(n)]
    terms = [F.lit(1.0), *x, *(x[i] * x[j] for i in range(n) for j in range(i + 1, n))]
    sums = named.agg(*_moments(terms, F.col("y"))).first()
    places = range(len(terms))
    gram = np.array([[sums[f"m{max(i, j)}_{min(i, j)}"] for j in places] for i in places], dtype=float)
    moment = np.array([sums[f"y{i}"] for i in places], dtype=float)
    if sums["labelled"] < sums["n"] or not (np.isfinite(gram).all() and np.isfinite(moment).all()):
        return PipelineModel([*prepared.stages, machine.fit(table)])
    return PipelineModel([*prepared.stages, _descend(machine, start, gram / sums["n"], moment / sums["n"])])


def training_ratios(ratios: DataFrame, key: str, *, fallback: bool = False) -> tuple[DataFrame, DataFrame, int]:
    """Training and held-out ratio rows, and the training percentage: 90, or with ``fallback`` what the rows allow."""
    rows = stage_by_key(numeric_class(ratios), "ratios", key)
    return encode.split_with_fallback(rows, F.col(key), fallback=fallback)


def score_multiplier(model: PipelineModel, quotes: DataFrame, prediction: str = "predicted_ratio") -> DataFrame:
    """Quotes with ``multiplier``, the prediction brought into its allowed range."""
    return model.transform(numeric_class(quotes)).withColumn(
        "multiplier", rules.clamp_multiplier(F.col(prediction))
    )


def price_scenarios(scored: DataFrame, base: Column | None = None) -> DataFrame:
    """Final price of each scored row on a base price."""
    on = F.lit(SCENARIO_BASE) if base is None else base
    return scored.withColumn("final_price", rules.final_price(on, F.col("multiplier")))
