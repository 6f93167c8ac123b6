"""The fare model: pipeline presets, fitting, importances and the metadata record."""

from __future__ import annotations

from dataclasses import dataclass

import json

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farekit.operators import encode, popularity
from farekit.operators.validation import Vocabularies
from farekit.plans import trees
from farekit.plans.features import CATEGORICAL, NUMERIC
from farekit.session import stage

LABEL, PREDICTION = "price", "predicted_price"

# The parameters of each estimator preset.
GBT_PARAMS = {
    "maxIter": 100,
    "maxDepth": 6,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "auto",
    "seed": 42,
}
RF_PARAMS = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 5, "seed": 42}

_ESTIMATORS = {"gbt": (GBTRegressor, GBT_PARAMS), "rf": (RandomForestRegressor, RF_PARAMS)}


def encoding_stages() -> list:
    """Index, one-hot, assemble and scale. Indexing all columns takes one pass over the rows."""
    indexed = [f"{c}_index" for c in CATEGORICAL]
    encoded = [f"{c}_encoded" for c in CATEGORICAL]
    return [
        StringIndexer(inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*encoded, *NUMERIC], outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False),
    ]


def fare_pipeline(preset: str = "gbt", **overrides) -> Pipeline:
    """The whole pipeline with the named estimator; keyword arguments change its parameters."""
    estimator, params = _ESTIMATORS[preset]
    last = estimator(featuresCol="features", labelCol=LABEL, predictionCol=PREDICTION, **{**params, **overrides})
    return Pipeline(stages=[*encoding_stages(), last])


@dataclass(frozen=True)
class TrainingTables:
    """Staged feature rows, their two parts with popularity, and the popularity table."""

    rows: DataFrame
    train: DataFrame
    held_out: DataFrame
    popularity: DataFrame


def training_tables(flights: DataFrame, key: str, percent: int = 80) -> TrainingTables:
    """Split feature rows by key and attach popularity, which the training part alone decides.

    The feature table is written to shared storage first: the passes of the fit
    then read only the columns they need, and a lost executor costs a re-read
    instead of the joins. It stays in the parts its joins have made: what a fit
    draws goes by the rows, not by their places.
    """
    marked = flights.withColumn("in_training", encode.in_training(F.col(key), percent))
    rows = stage(marked, "training", compression="zstd")
    train, held_out = rows.where("in_training"), rows.where(~F.col("in_training"))
    known = popularity.popularity_table(train)
    return TrainingTables(
        rows,
        popularity.add_popularity(train.drop("in_training"), known),
        popularity.add_popularity(held_out.drop("in_training"), known, fallback=True),
        known,
    )


def fit_fare_model(train: DataFrame, preset: str = "gbt", **overrides) -> PipelineModel:
    return trees.fit_trees(fare_pipeline(preset, **overrides), train)


_ATTRIBUTES = "ml_attr struct<attrs: map<string, array<struct<idx: int, name: string>>>>"


def slot_names(assembled: DataFrame, column: str = "raw_features") -> DataFrame:
    """(slot, feature, source) of every vector entry, as the assembled column describes itself.

    The source of a one-hot slot is the column that was encoded, of any other slot its own name.
    """
    described = json.dumps(assembled.schema[column].metadata)
    attributes = F.from_json(F.lit(described), _ATTRIBUTES).getField("ml_attr").getField("attrs")
    slots = assembled.sparkSession.range(1).select(F.inline(F.flatten(F.map_values(attributes))))
    encoded = F.regexp_extract("name", f"^({'|'.join(CATEGORICAL)})_encoded_", 1)
    source = F.coalesce(F.nullif(encoded, F.lit("")), F.col("name"))
    return slots.select(F.col("idx").alias("slot"), F.col("name").alias("feature"), source.alias("source"))


def importances_of(slots: DataFrame, weights: DataFrame) -> DataFrame:
    """(slot, feature, source, importance): the slots with the weights (slot, importance) of a model."""
    return slots.join(weights, "slot").select("slot", "feature", "source", "importance")


def importances(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Importance of every vector slot with its own name and its source column.

    One row per slot: as many as the model has labels and numbers.
    """
    values = model.stages[-1].featureImportances.toArray()
    weights = pd.DataFrame({"slot": np.arange(len(values), dtype="int32"), "importance": values})
    return importances_of(slot_names(model.transform(rows)), rows.sparkSession.createDataFrame(weights))


def importance_by_source(slots: DataFrame) -> DataFrame:
    return slots.groupBy("source").agg(F.sum("importance").alias("importance"))


def top_importances(slots: DataFrame, k: int = 10) -> DataFrame:
    by_source = importance_by_source(slots)
    return by_source.orderBy(F.desc("importance"), "source").limit(k)


def prediction_sample(predictions: DataFrame, *columns: str) -> DataFrame:
    """Named columns of the predictions with the absolute error."""
    return predictions.select(
        *columns, LABEL, PREDICTION, F.abs(F.col(LABEL) - F.col(PREDICTION)).alias("error")
    )


def metadata_record(metrics: DataFrame, names: Vocabularies, rows: Column, training_date: str) -> DataFrame:
    """One row: vocabularies, metrics, training date and training rows.

    The record's format asks for the vocabularies as arrays; they hold distinct names only.
    ``rows`` is a scalar column, such as the subquery that counts the training part.
    """
    airlines = names.airlines.select(F.array_sort(F.collect_list("airline"))).scalar()
    cities = names.cities.select(F.array_sort(F.collect_list("city"))).scalar()
    return metrics.select(
        airlines.alias("valid_airlines"),
        cities.alias("valid_cities"),
        "rmse",
        "mae",
        "r2",
        F.lit(training_date).alias("training_date"),
        rows.alias("total_flights_trained"),
    )
