"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.catalog.registry import query
from farekit.catalog.views import with_fares, with_flights, with_priced, with_requests
from farekit.operators import profile
from farekit.session import scratch_path
from farekit.sources import fixtures, inference, readers, schemas, sinks

_FLIGHTS_SQL = with_flights("SELECT * FROM flights")


def _flights_csv(spark, sf_dir):
    path = scratch_path(spark, "flights-csv")
    sinks.write_csv(fixtures.flights(spark, sf_dir), path)
    return path


@query("s01_typed_scan", _FLIGHTS_SQL)
def s01(spark, sf_dir):
    """The whole flights file with the types that its values have."""
    return inference.read_inferred_csv(spark, _flights_csv(spark, sf_dir))


@query("s01_declared_scan", _FLIGHTS_SQL)
def s01_declared(spark, sf_dir):
    return readers.read_typed_csv(spark, _flights_csv(spark, sf_dir), schemas.FLIGHTS)


@query("s02_untyped_scan", _FLIGHTS_SQL)
def s02(spark, sf_dir):
    return readers.cast_columns(readers.read_untyped_csv(spark, _flights_csv(spark, sf_dir)), schemas.FLIGHTS)


@query(
    "s03_table_sink",
    with_flights("SELECT count(*) AS n, CAST(sum(price) AS BIGINT) AS total_price, count(DISTINCT route) AS routes FROM flights"),
)
def s03(spark, sf_dir):
    back = readers.read_typed_csv(spark, _flights_csv(spark, sf_dir), schemas.FLIGHTS)
    return back.agg(F.count("*").alias("n"), F.sum("price").alias("total_price"), F.count_distinct("route").alias("routes"))


_SUMMARY_SQL = with_fares("""
SELECT count(*) AS total_flights, round(count(*) / 365.0e0, 6) AS avg_flights_per_day,
       count(DISTINCT source_city || ' → ' || destination_city) AS total_routes,
       '₹' || CAST(CAST(round_even(avg(price), 0) AS BIGINT) AS VARCHAR) AS avg_price,
       CAST(min(date) AS VARCHAR) || ' to ' || CAST(max(date) AS VARCHAR) AS date_range
FROM fares""")


@query("s04_summary_sink", _SUMMARY_SQL)
def s04(spark, sf_dir):
    path = scratch_path(spark, "summary-csv")
    table = profile.summary(inputs.routed_fares(spark, sf_dir, "price", "date"), 365)
    sinks.write_csv(table.withColumn("avg_flights_per_day", F.round("avg_flights_per_day", 6)), path)
    return readers.read_typed_csv(spark, path, table.schema)


@query("a17_summary", _SUMMARY_SQL)
def a17(spark, sf_dir):
    table = profile.summary(inputs.routed_fares(spark, sf_dir, "price", "date"), 365)
    return table.withColumn("avg_flights_per_day", F.round("avg_flights_per_day", 6))


METADATA_SQL = with_priced(f"""
SELECT (SELECT string_agg(airline, ',' ORDER BY airline) FROM (SELECT DISTINCT airline FROM fares)) AS airlines,
       (SELECT string_agg(city, ',' ORDER BY city)
        FROM (SELECT source_city AS city FROM fares UNION SELECT destination_city FROM fares)) AS cities,
       round(sqrt(avg((price - rule_price) * (price - rule_price))), 6) AS rmse,
       round(avg(abs(price - rule_price)), 6) AS mae,
       round(1 - sum((price - rule_price) * (price - rule_price))
                 / (var_pop(price) * count(*)), 6) AS r2,
       '{inputs.TRAINING_DATE}' AS training_date,
       (SELECT count(*) FROM priced WHERE key_hash % 100 < 80) AS total_flights_trained
FROM priced WHERE key_hash % 100 >= 80""")


def _flat(record):
    return record.select(
        F.array_join("valid_airlines", ",").alias("airlines"),
        F.array_join("valid_cities", ",").alias("cities"),
        *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")],
        "training_date",
        "total_flights_trained",
    )


@query("m17_model_metadata", METADATA_SQL)
def m17(spark, sf_dir):
    return _flat(inputs.rule_metadata(spark, sf_dir))


@query("s05_metadata_sink", METADATA_SQL)
def s05(spark, sf_dir):
    path = scratch_path(spark, "metadata")
    sinks.write_metadata(inputs.rule_metadata(spark, sf_dir), path)
    return _flat(readers.read_metadata(spark, path, pretty=True))


@query("s06_metadata_source", METADATA_SQL)
def s06(spark, sf_dir):
    path = scratch_path(spark, "metadata")
    inputs.rule_metadata(spark, sf_dir).write.json(path)
    return _flat(readers.read_metadata(spark, path))


@query("s07_model_sink")
def s07(spark, sf_dir):
    """Predictions of the saved and reloaded model beside those of the fitted one."""
    fit = inputs.fare_fit(spark, sf_dir)
    path = scratch_path(spark, "fare-model")
    sinks.save_model(fit.model, path)
    fitted = fit.model.transform(fit.held_out).select(*fit.held_out.columns, F.col("predicted_price").alias("fitted_price"))
    return readers.load_model(path).transform(fitted).select("fare_key", "fitted_price", "predicted_price")


@query("s07_reloaded_equals_fitted", with_priced("SELECT fare_key, true AS equal FROM priced WHERE key_hash % 100 >= 80"))
def s07_equal(spark, sf_dir):
    return s07(spark, sf_dir).select("fare_key", (F.col("fitted_price") == F.col("predicted_price")).alias("equal"))


@query("s08_scored_rows", with_priced("SELECT fare_key, composed_price AS price, true AS predicted FROM priced WHERE key_hash % 100 >= 80"))
def s08_rows(spark, sf_dir):
    return s08(spark, sf_dir).select("fare_key", "price", F.col("predicted_price").isNotNull().alias("predicted"))


@query("s08_model_source")
def s08(spark, sf_dir):
    fit = inputs.fare_fit(spark, sf_dir)
    path = scratch_path(spark, "fare-model")
    sinks.save_model(fit.model, path)
    return readers.load_model(path).transform(fit.held_out).select("fare_key", "price", "predicted_price")


@query("s09_request_source", with_requests("SELECT * FROM requests"))
def s09(spark, sf_dir):
    path = scratch_path(spark, "requests")
    inputs.requests(spark, sf_dir).write.parquet(path)
    return readers.read_requests(spark, path)


@query("s09_json_requests", with_requests("SELECT * FROM requests"))
def s09_json(spark, sf_dir):
    path = scratch_path(spark, "json-requests")
    inputs.requests(spark, sf_dir).write.json(path)
    return readers.read_json_requests(spark, path).drop(schemas.UNREADABLE)


@query(
    "s10_preview",
    with_fares("SELECT fare_key, airline, class, price FROM fares ORDER BY fare_key, price, airline, class LIMIT 10"),
)
def s10(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key", "airline", "class", "price")
    return rows.orderBy("fare_key", "price", "airline", "class").limit(10)
