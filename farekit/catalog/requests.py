"""Request validation, quoting and their streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.catalog.joins import _ROUTES_SQL
from farekit.catalog.registry import query
from farekit.catalog.scans import METADATA_SQL
from farekit.catalog.views import with_checked, with_fares, with_filled, with_quick
from farekit.operators import validation
from farekit.plans import quoting
from farekit.session import scratch_path
from farekit.sources import fixtures, readers, schemas
from farekit.streaming import scoring


def _checked(spark, sf_dir):
    return validation.with_reasons(inputs.requests(spark, sf_dir), inputs.vocabularies(spark, sf_dir))


def _rule(name: str, *reasons: str):
    """Register a query that gives, for each request, whether the rule is broken."""
    broken_sql = " OR ".join(reasons)

    @query(name, with_checked(f"SELECT request_id, {broken_sql} AS broken FROM flagged"))
    def run(spark, sf_dir):
        found = F.arrays_overlap("reasons", F.array(*[F.lit(reason) for reason in reasons]))
        return _checked(spark, sf_dir).select("request_id", found.alias("broken"))

    return run


_rule("v01_known_airline", "unknown_airline")
_rule("v02_known_cities", "unknown_source_city", "unknown_destination_city")
_rule("v03_different_cities", "same_city")
_rule("v04_ranges", *[f"{name}_out_of_range" for name in validation.RANGES])
_rule("v05_enumerations", *[f"bad_{name}" for name in validation.LISTS])
_rule("v06_required_fields", *[f"missing_{name}" for name in validation.REQUIRED])
_rule("v07_valid_date", "bad_flight_date")


@query("v08_accepted", with_checked("SELECT * FROM requests WHERE request_id IN (SELECT request_id FROM checked WHERE reasons = '')"))
def v08_accepted(spark, sf_dir):
    return validation.accepted(_checked(spark, sf_dir))


@query("v08_rejected", with_checked("SELECT request_id, reasons FROM checked WHERE reasons <> ''"))
def v08_rejected(spark, sf_dir):
    rejects = validation.rejected(_checked(spark, sf_dir))
    return rejects.select("request_id", F.array_join("reasons", ",").alias("reasons"))


# Every 23rd line each: cut off, no JSON at all, a word where a number belongs.
_BROKEN = (
    (3, '{"request_id":', ',"airline":"SMA'), (8, "no request ", ""),
    (13, '{"request_id":', ',"days_before_departure":"soon"}'),
)
_BROKEN_SQL = " ".join(f"WHEN {n} THEN '{a}' || request_id || '{b}'" for n, a, b in _BROKEN)


def _request_lines(spark, sf_dir):
    """The requests as lines of JSON, some of them broken; a path."""
    rows = inputs.requests(spark, sf_dir)
    line = F.to_json(F.struct(*rows.columns))
    for n, before, after in _BROKEN:
        broken = F.concat(F.lit(before), F.col("request_id").cast("string"), F.lit(after))
        line = F.when(F.col("request_id") % 23 == n, broken).otherwise(line)
    path = scratch_path(spark, "request-lines")
    rows.select(line.alias("value")).write.text(path)
    return path


@query(
    "v08_unreadable",
    with_checked(f"""
SELECT CASE WHEN line IS NULL THEN request_id END AS request_id, line AS unreadable_text,
       CASE WHEN line IS NULL THEN reasons ELSE 'unreadable' END AS reasons
FROM (SELECT *, CASE request_id % 23 {_BROKEN_SQL} END AS line FROM checked) lines"""),
)
def v08_unreadable(spark, sf_dir):
    """Every line once: with no reason if it is accepted, with its text if it is no request."""
    lines = readers.read_json_requests(spark, _request_lines(spark, sf_dir))
    checked = validation.with_reasons(lines, inputs.vocabularies(spark, sf_dir))
    readable = F.when(F.col(schemas.UNREADABLE).isNull(), F.col("request_id"))
    return checked.select(readable.alias("request_id"), schemas.UNREADABLE, F.array_join("reasons", ",").alias("reasons"))


@query(
    "v09_option_listing",
    with_fares("""
SELECT DISTINCT 'airline' AS kind, airline AS value FROM fares
UNION ALL SELECT 'city', city FROM (SELECT source_city AS city FROM fares UNION SELECT destination_city FROM fares) c
UNION ALL SELECT * FROM (VALUES ('departure_time', 'Early_Morning'), ('departure_time', 'Morning'),
  ('departure_time', 'Afternoon'), ('departure_time', 'Evening'), ('departure_time', 'Night'),
  ('cabin_class', 'Economy'), ('cabin_class', 'Premium_Economy'), ('cabin_class', 'Business'),
  ('stops', 'zero'), ('stops', 'one'), ('stops', 'two_or_more'),
  ('season', 'Winter'), ('season', 'Summer'), ('season', 'Monsoon'), ('season', 'Post_Monsoon')) AS fixed(kind, value)"""),
)
def v09(spark, sf_dir):
    return validation.option_listing(inputs.vocabularies(spark, sf_dir))


@query(
    "v09_city_roles",
    with_fares("""
SELECT city, bool_or(origin) AS as_source, bool_or(NOT origin) AS as_destination
FROM (SELECT source_city AS city, true AS origin FROM fares
      UNION ALL SELECT destination_city, false FROM fares) seen GROUP BY city"""),
)
def v09_roles(spark, sf_dir):
    return inputs.vocabularies(spark, sf_dir).cities


@query(
    "v10_request_features",
    with_filled(f"""
SELECT request_id, distance_km, distance_km * distance_km AS distance_squared,
       round(distance_km / 750.0e0, 6) AS duration,
       CAST(CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 ELSE 2 END AS INTEGER) AS stop_count,
       CASE WHEN days_before_departure <= 3 THEN 5.0e0 WHEN days_before_departure <= 7 THEN 3.5e0
            WHEN days_before_departure <= 14 THEN 2.0e0 WHEN days_before_departure <= 30 THEN 1.0e0
            WHEN days_before_departure <= 60 THEN 0.5e0 ELSE 0.2e0 END AS booking_urgency_score,
       is_weekend, is_holiday, month, CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter,
       CAST(CASE WHEN departure_time IN ('Morning', 'Evening') THEN 1 ELSE 0 END AS INTEGER) AS is_peak_time,
       coalesce(route_frequency, 100) AS route_frequency,
       round(coalesce(route_frequency * 1.0e0 / (SELECT max(route_frequency) FROM {_ROUTES_SQL} m), 0.5e0), 6)
         AS route_popularity_score
FROM filled LEFT JOIN {_ROUTES_SQL} r ON r.route = source_city || '-' || destination_city"""),
)
def v10_features(spark, sf_dir):
    rows, _ = quoting.prepared(inputs.requests(spark, sf_dir), inputs.quote_context(spark, sf_dir, scored=False))
    return rows.select(
        "request_id", "distance_km", "distance_squared", F.round("duration", 6).alias("duration"), "stop_count",
        "booking_urgency_score", "is_weekend", "is_holiday", "month", "quarter", "is_peak_time", "route_frequency",
        F.round("route_popularity_score", 6).alias("route_popularity_score"),
    )


def _flat(responses):
    return responses.select(
        "request_id", "predicted_price", "currency", "flight_details.*",
        "booking_insight", "price_trend", "model_confidence", "savings_tip",
    )


@query("v10_batch_quote")
def v10(spark, sf_dir):
    return _flat(quoting.quote(inputs.requests(spark, sf_dir), inputs.quote_context(spark, sf_dir))[0])


_RESPONSE_SQL = """
SELECT request_id, 'INR' AS currency, source_city || ' → ' || destination_city AS route, airline, cabin_class AS class,
       departure_time, distance_km, stops, days_before_departure, flight_date, is_weekend = 1 AS is_weekend,
       is_holiday = 1 AS is_holiday, true AS price_in_tens FROM filled"""


def _without_price(flat):
    """The fields that don't depend on the model, and whether the price is a whole number of tens."""
    return flat.select(*_SHOWN, (F.col("predicted_price") % 10 == 0).alias("price_in_tens"))


_SHOWN = (
    "request_id", "currency", "route", "airline", "class", "departure_time", "distance_km", "stops",
    "days_before_departure", "flight_date", "is_weekend", "is_holiday",
)


@query("v10_batch_fields", with_filled(_RESPONSE_SQL))
def v10_fields(spark, sf_dir):
    return _without_price(v10(spark, sf_dir))


@query("v11_quick_fields", with_quick(_RESPONSE_SQL))
def v11_fields(spark, sf_dir):
    return _without_price(v11(spark, sf_dir))


_QUICK = (
    "request_id", "departure_time", "cabin_class", "days_before_departure", "distance_km", "stops", "month",
    "day_of_week", "is_weekend", "is_holiday", "flight_date",
)


@query("v11_quick_defaults", with_quick(f"SELECT {', '.join(_QUICK)} FROM filled"))
def v11_defaults(spark, sf_dir):
    asked = quoting.quick_request(inputs.requests(spark, sf_dir))
    rows, _ = quoting.prepared(asked, inputs.quote_context(spark, sf_dir, scored=False))
    return rows.select(*_QUICK)


@query("v11_quick_quote")
def v11(spark, sf_dir):
    asked = quoting.quick_request(inputs.requests(spark, sf_dir))
    return _flat(quoting.quote(asked, inputs.quote_context(spark, sf_dir))[0])


@query(
    "v12_model_status",
    f"""
SELECT 'healthy' AS status, true AS model_loaded,
       CAST(len(string_split(airlines, ',')) AS INTEGER) AS valid_airlines_count,
       CAST(len(string_split(cities, ',')) AS INTEGER) AS valid_cities_count, rmse, mae, r2,
       format('{{:,}}', total_flights_trained) || ' flights' AS trained_on,
       '₹' || printf('%.2f', rmse) AS rmse_text, printf('%.4f', r2) AS r2_text
FROM ({METADATA_SQL}) metadata""",
)
def v12(spark, sf_dir):
    table = quoting.status(inputs.rule_metadata(spark, sf_dir))
    return table.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


def _event_stream(spark, sf_dir):
    files = spark.readStream.schema(schemas.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return fixtures.requests(files)


def _one_run(spark, sf_dir):
    """One stream over the requests that writes quotes and rejects; all streaming queries read what it wrote."""

    def run():
        path = scratch_path(spark, "scoring-run")
        context = inputs.quote_context(spark, sf_dir)
        scoring.start_scoring(_event_stream(spark, sf_dir), context, f"{path}/out", f"{path}/checkpoint").awaitTermination()
        return f"{path}/out"

    return inputs.once(spark, (sf_dir, "scoring-run"), run)


@query("st1_stream_quotes")
def st1(spark, sf_dir):
    return _flat(spark.read.parquet(f"{_one_run(spark, sf_dir)}/quotes"))


@query("st1_stream_fields", with_filled(_RESPONSE_SQL.replace("true AS price_in_tens", "true AS price_in_tens, true AS as_in_batch")))
def st1_fields(spark, sf_dir):
    """The streamed responses, and whether each equals the batch response."""
    batch = v10(spark, sf_dir).select("request_id", F.struct("*").alias("batch"))
    streamed = st1(spark, sf_dir)
    whole = streamed.withColumn("whole", F.struct(*streamed.columns)).join(batch, "request_id", "left")
    return whole.select(
        *_SHOWN, (F.col("predicted_price") % 10 == 0).alias("price_in_tens"),
        F.coalesce(F.col("whole") == F.col("batch"), F.lit(False)).alias("as_in_batch"),
    )


_REJECTS_SQL = with_checked("SELECT request_id, reasons FROM checked WHERE reasons <> ''")


@query("st2_one_pass_rejects", _REJECTS_SQL)
def st2_one_pass(spark, sf_dir):
    """The rejects of the run that made the quotes."""
    rejects = spark.read.parquet(f"{_one_run(spark, sf_dir)}/rejects")
    return rejects.select("request_id", F.array_join("reasons", ",").alias("reasons"))


@query("st2_stream_rejects", _REJECTS_SQL)
def st2(spark, sf_dir):
    """Rejects alone, for which no model is needed."""
    path = scratch_path(spark, "stream-rejects")
    names = inputs.vocabularies(spark, sf_dir)
    run = scoring.start_rejects(_event_stream(spark, sf_dir), names, f"{path}/out", f"{path}/checkpoint")
    run.awaitTermination()
    rejects = spark.read.parquet(f"{path}/out")
    return rejects.select("request_id", F.array_join("reasons", ",").alias("reasons"))


@query(
    "st_conservation",
    with_checked("""
SELECT count(*) AS requests, count(*) FILTER (WHERE reasons = '') AS quotes, count(*) FILTER (WHERE reasons <> '') AS rejects,
       CAST(0 AS BIGINT) AS repeated FROM checked"""),
)
def st_conservation(spark, sf_dir):
    """Requests, quotes and rejects of the one run, and how many requests came out twice."""
    out = _one_run(spark, sf_dir)
    ids = lambda part: spark.read.parquet(f"{out}/{part}").select("request_id", F.lit(part).alias("part"))
    every = ids("quotes").union(ids("rejects")).groupBy("request_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("part") == "quotes").alias("quotes")
    )
    return every.agg(
        F.count("*").alias("requests"), F.sum("quotes").alias("quotes"), F.sum(F.col("n") - F.col("quotes")).alias("rejects"),
        F.sum(F.col("n") - 1).alias("repeated"),
    )
