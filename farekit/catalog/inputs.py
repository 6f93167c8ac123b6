"""Shared inputs of the registered queries."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farekit.functions import rules
from farekit.operators import baseline, encode, popularity
from farekit.operators.validation import Vocabularies
from farekit.plans import features, multiplier, training
from farekit.plans.quoting import QuoteContext
from farekit.session import stage, stage_by_key
from farekit.sources import fixtures

TRAINING_DATE = "2025-01-01"
AS_OF_DATE = "2025-06-15"


def routed_fares(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = fixtures.fares(spark, sf_dir, "source_city", "destination_city", *columns)
    return rows.withColumn("route", rules.route_key(F.col("source_city"), F.col("destination_city")))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.requests(fixtures.table(spark, sf_dir, "events"))


def vocabularies(spark: SparkSession, sf_dir: str) -> Vocabularies:
    return Vocabularies.of(fixtures.fares(spark, sf_dir, "airline", "source_city", "destination_city"))


def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced fares with the model's columns except popularity; the label is the composed price."""
    rows = fixtures.priced_fares(spark, sf_dir, "stops").withColumn(
        "duration", rules.nominal_duration(F.col("distance_km"))
    )
    columns = features.engineered_columns(features.calendar_columns(rows))
    kept = dict.fromkeys((*features.CATEGORICAL, *features.NUMERIC, "route"))
    kept.pop("route_popularity_score")
    return columns.select("fare_key", *kept, "rule_price", F.col("composed_price").alias("price"))


def rule_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata record of the rule price as predictor, measured on the held-out part."""
    rows = stage(fixtures.priced_fares(spark, sf_dir, "price").select("fare_key", "rule_price", "price"), "rule-prices")
    train, held_out = encode.split(rows, F.col("fare_key"))
    metrics = encode.regression_metrics(held_out, "price", "rule_price")
    trained = train.select(F.count("*")).scalar()
    return training.metadata_record(metrics, vocabularies(spark, sf_dir), trained, TRAINING_DATE)


@dataclass(frozen=True)
class FareFit:
    model: PipelineModel
    train: DataFrame
    held_out: DataFrame
    rows: DataFrame
    popularity: DataFrame

    @cached_property
    def r2(self) -> float:
        """Measured when first asked for: it scores all held-out rows."""
        return encode.regression_metrics(self.model.transform(self.held_out), "price", training.PREDICTION).first()["r2"]


_fits: dict[tuple, object] = {}


def once(spark: SparkSession, key: tuple, make):
    """Fit a model, or run a stream, once per application and table folder."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _fits:
        _fits[full] = make()
    return _fits[full]


def _training_tables(spark: SparkSession, sf_dir: str):
    return once(
        spark,
        (sf_dir, "tables"),
        # The rule price is no input of the model.
        lambda: training.training_tables(training_features(spark, sf_dir).drop("rule_price"), "fare_key"),
    )


def fare_fit(spark: SparkSession, sf_dir: str, preset: str = "gbt") -> FareFit:
    def make():
        tables = _training_tables(spark, sf_dir)
        model = training.fit_fare_model(tables.train, preset)
        return FareFit(model, tables.train, tables.held_out, tables.rows, tables.popularity)

    return once(spark, (sf_dir, preset), make)


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.with_ratio(fixtures.quotes(spark, sf_dir, "fare_key"))


def notebook_fit(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    def make():
        train, held_out, _ = multiplier.training_ratios(ratios(spark, sf_dir), "fare_key")
        return multiplier.fit_machine(multiplier.notebook_pipeline(), train), train, held_out

    return once(spark, (sf_dir, "notebook"), make)


def stored_fit(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    def make():
        labelled = ratios(spark, sf_dir).withColumnRenamed("price_ratio", "price_multiplier")
        rows = stage_by_key(labelled, "multipliers", "fare_key")
        train, held_out = encode.split(rows, F.col("fare_key"))
        return multiplier.fit_machine(multiplier.stored_pipeline(), train), held_out

    return once(spark, (sf_dir, "stored"), make)


def quote_context(spark: SparkSession, sf_dir: str, scored: bool = True) -> QuoteContext:
    distances = fixtures.fixture_distances(spark, sf_dir)
    if not scored:
        # Names and routes come from one count of the fares by airline and cities.
        rows = fixtures.fares(spark, sf_dir, "airline", "source_city", "destination_city")
        counts = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
        counts = stage(counts.withColumn("route", rules.route_key(F.col("source_city"), F.col("destination_city"))), "flown")
        known = popularity.popularity_of(counts.groupBy("route").agg(F.sum("n").alias("route_frequency")))
        return QuoteContext(Vocabularies.of(counts), distances, known, AS_OF_DATE)
    fit = fare_fit(spark, sf_dir)
    # The staged rows have all fares with their names, so the tables need not be joined again.
    names = Vocabularies.of(fit.rows)
    return QuoteContext(names, distances, fit.popularity, AS_OF_DATE, fit.model, fit.r2)
