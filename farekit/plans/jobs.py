"""Whole jobs from source tables to written results."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farekit.operators import baseline, encode, popularity, profile, validation
from farekit.operators.validation import Vocabularies
from farekit.plans import features, multiplier, quoting, training
from farekit.session import scratch_scope, stage
from farekit.sources import dims, readers, sinks
from farekit.streaming import scoring

YEAR_DAYS = 365


def _job(function):
    """A job that reads the table in its first argument and leaves nothing staged behind."""

    @wraps(function)
    def run(table: DataFrame, *args, **kwargs) -> None:
        with scratch_scope(table.sparkSession):
            function(table, *args, **kwargs)

    return run


@_job
def report(flights: DataFrame, out: str, days: int = YEAR_DAYS) -> None:
    """Describe a flights table: one headed CSV per part of the report."""
    spark = flights.sparkSession
    found = profile.Report.of(flights, days)
    parts = {
        "summary": found.summary(),
        "airlines": found.shares("airline").orderBy(F.desc("n"), "airline"),
        "classes": found.shares("class").orderBy(F.desc("n"), "class"),
        "top_routes": found.top_routes(10),
        "prices": found.prices(),
        "median_price": found.median_price(),
        "peak_days": found.busiest_days(dims.calendar(spark), 5),
    }
    for name, table in parts.items():
        sinks.write_csv(table, f"{out}/{name}")


@_job
def train_fares(flights: DataFrame, out: str, training_date: str, preset: str = "gbt", **overrides) -> None:
    """Fit the fare model and write model, metadata, popularity, importances, metrics and the report of dropped rows.

    Rows that lack a feature or the price are left out of training and of the
    count of trained rows; ``dropped`` says how many were kept and dropped.
    """
    columns = dict.fromkeys(("flight_id", *features.CATEGORICAL, *features.NUMERIC, "route", training.LABEL))
    columns.pop("route_popularity_score")
    rows = features.engineered_columns(flights).select(*columns)
    complete, dropped = profile.without_incomplete(rows, [c for c in columns if c != "flight_id"])
    rows = stage(complete, "features")  # counts what it drops as it writes
    sinks.write_csv(dropped.report(), f"{out}/dropped")
    tables = training.training_tables(rows, "flight_id")
    model = training.fit_fare_model(tables.train, preset, **overrides)
    sinks.save_model(model, f"{out}/model")
    sinks.write_parquet(tables.popularity, f"{out}/popularity")
    metrics = stage(
        encode.regression_metrics(model.transform(tables.held_out), training.LABEL, training.PREDICTION), "metrics"
    )
    sinks.write_csv(metrics, f"{out}/metrics")
    trained = tables.train.select(F.count("*")).scalar()
    record = training.metadata_record(metrics, Vocabularies.of(tables.rows), trained, training_date)
    sinks.write_metadata(record, f"{out}/metadata")
    sinks.write_csv(training.importances(model, tables.train), f"{out}/importances")


@_job
def fit_multiplier(
    quotes: DataFrame, out: str, preset: str = "notebook", *, fallback: bool = False, **overrides
) -> None:
    """Describe quotes by lead time and class, fit the multiplier and price the scenarios.

    ``fallback`` lets a table that holds out too few rows be split otherwise; the
    metrics name the training percentage, 100 meaning that they are of training rows.
    """
    quotes = stage(quotes, "quotes")
    sets = {"by_days_left": ["days_left"], "by_class": ["classx"], "by_flight": ["flight", "days_left"]}
    stats = stage(profile.stats_by_sets(quotes, "price", sets), "price-stats")
    for name, keys in sets.items():
        measures = ["avg_price", "count"] if name == "by_flight" else ["avg_price", "min_price", "max_price", "count"]
        sinks.write_csv(stats.where(F.col("part") == name).select(*keys, *measures).orderBy(*keys), f"{out}/{name}")
    bases = stage(baseline.baselines_of_stats(stats.where(F.col("part") == "by_flight")), "baseline")
    ratios = stage(baseline.with_ratio_to(quotes, bases), "quote-ratios")
    sinks.write_csv(baseline.ratio_stats(ratios).orderBy("days_left", "classx"), f"{out}/ratios")

    key = F.concat_ws("|", "flight", "days_left", "classx", "price").alias("quote_key")
    train, held_out, percent = multiplier.training_ratios(ratios.withColumn("quote_key", key), "quote_key", fallback=fallback)
    if preset == "stored":
        label, prediction = "price_multiplier", "predicted_multiplier"
        train = train.withColumnRenamed("price_ratio", label)
        held_out = held_out.withColumnRenamed("price_ratio", label)
        model = multiplier.fit_machine(multiplier.stored_pipeline(**overrides), train)
    else:
        label, prediction = "price_ratio", "predicted_ratio"
        model = multiplier.fit_machine(multiplier.notebook_pipeline(**overrides), train)
    sinks.save_model(model, f"{out}/model")
    metrics = encode.regression_metrics(model.transform(held_out), label, prediction)
    sinks.write_csv(metrics.withColumn("training_percent", F.lit(percent)), f"{out}/metrics")

    grid = baseline.scenario_grid(bases, multiplier.SCENARIO_DAYS, multiplier.SCENARIO_CLASSES)
    scored = multiplier.price_scenarios(multiplier.score_multiplier(model, grid, prediction), F.col("baseline_price"))
    shown = ("flight", "days_left", "classx", "baseline_price", "multiplier", "final_price")
    sinks.write_csv(scored.select(*shown), f"{out}/scenarios")


def load_context(spark: SparkSession, trained: str, as_of_date: str) -> quoting.QuoteContext:
    """What ``train_fares`` wrote, ready for scoring."""
    metadata = readers.read_metadata(spark, f"{trained}/metadata", pretty=True)
    return quoting.QuoteContext(
        names=Vocabularies.from_metadata(metadata),
        distances=dims.distances(spark),
        popularity=spark.read.schema(popularity.SCHEMA).parquet(f"{trained}/popularity"),
        as_of_date=as_of_date,
        model=readers.load_model(f"{trained}/model"),
        r2=metadata.first()["r2"],
    )


def quote_requests(requests: DataFrame, context: quoting.QuoteContext, out: str, trigger: dict | None = None) -> None:
    """Score a request table, or a request stream: until it has nothing new, or as ``trigger`` says."""
    if requests.isStreaming:
        run = scoring.start_scoring(requests, context, out, f"{out}/checkpoints", trigger)
        try:
            run.awaitTermination()
        finally:
            run.stop()
        return
    with scratch_scope(requests.sparkSession):
        checked = stage(validation.with_reasons(requests, context.names), "checked")
        sinks.write_parquet(quoting.quote_checked(checked, context), f"{out}/quotes")
        sinks.write_parquet(validation.rejected(checked), f"{out}/rejects")
