"""Validation, defaults, quoting and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.operators import validation
from farekit.plans import quoting
from farekit.session import scratch_path
from farekit.sources import dims, fixtures, schemas
from farekit.streaming import scoring

GOOD = {
    "request_id": 77, "airline": "Vistara", "source_city": "Delhi", "destination_city": "Goa",
    "departure_time": "Evening", "cabin_class": "Business", "days_before_departure": 12, "flight_date": "2025-11-22",
    "distance_km": 1420.0, "stops": "one", "is_weekend": 0, "is_holiday": 0,
}


@pytest.fixture(scope="module")
def names(spark):
    flights = spark.createDataFrame(
        [("IndiGo", "Delhi", "Mumbai"), ("Vistara", "Mumbai", "Goa")],
        "airline string, source_city string, destination_city string",
    )
    return validation.Vocabularies.of(flights)


@pytest.mark.parametrize(
    ("change", "reasons"),
    [
        ({}, []),
        ({"airline": "Nobody"}, ["unknown_airline"]),
        ({"source_city": "Atlantis"}, ["unknown_source_city"]),
        ({"destination_city": "Delhi"}, ["same_city"]),
        ({"days_before_departure": 0}, []),
        ({"days_before_departure": 90}, []),
        ({"days_before_departure": 91}, ["days_before_departure_out_of_range"]),
        ({"days_before_departure": -1}, ["days_before_departure_out_of_range"]),
        ({"distance_km": 99.9}, ["distance_km_out_of_range"]),
        ({"distance_km": None}, []),
        ({"departure_time": "Noon"}, ["bad_departure_time"]),
        ({"departure_time": None, "cabin_class": None}, ["missing_cabin_class", "missing_departure_time"]),
        ({"stops": None, "is_weekend": None, "is_holiday": None}, []),
        ({"stops": "five"}, ["bad_stops"]),
        ({"is_weekend": 2}, ["is_weekend_out_of_range"]),
        ({"flight_date": "2025-13-01"}, ["bad_flight_date"]),
        ({"flight_date": ""}, []),
        ({"flight_date": None}, []),
        ({"airline": None}, ["missing_airline"]),
        ({"airline": "X", "source_city": "Goa", "destination_city": "Goa"}, ["same_city", "unknown_airline"]),
    ],
)
def test_reasons(spark, names, change, reasons):
    request = {**GOOD, **change}
    row = [tuple(request[name] for name in GOOD)]
    checked = validation.with_reasons(spark.createDataFrame(row, schemas.REQUESTS), names)
    assert checked.first().reasons == reasons


def test_city_roles(names):
    assert {tuple(r) for r in names.cities.collect()} == {
        ("Delhi", True, False), ("Mumbai", True, True), ("Goa", False, True),
    }


def test_accepted_and_rejected_make_up_the_input(spark, data_dir):
    asked = inputs.requests(spark, data_dir)
    checked = validation.with_reasons(asked, inputs.vocabularies(spark, data_dir))
    kept, turned_away = validation.accepted(checked), validation.rejected(checked)
    assert kept.count() > 0 and turned_away.count() > 0
    both = kept.select("request_id").union(turned_away.select("request_id"))
    assert sorted(both.collect()) == sorted(asked.select("request_id").collect())


def _filled(spark, **change):
    row = [tuple({**GOOD, **change}[name] for name in GOOD)]
    asked = spark.createDataFrame(row, schemas.REQUESTS)
    return quoting.with_defaults(asked, dims.distances(spark), "2025-06-15").first()


def test_a_given_date_decides(spark):
    row = _filled(spark, is_weekend=0)  # 2025-11-22 is a Saturday
    assert (row.month, row.quarter, row.season, row.day_of_week, row.is_weekend) == (
        11, 4, "Post_Monsoon", "Saturday", 1,
    )


def test_without_a_date_the_defaults_apply(spark):
    row = _filled(spark, flight_date="", is_weekend=1, is_holiday=None, stops=None, distance_km=None)
    assert (row.month, row.season, row.day_of_week, row.is_weekend) == (6, "Monsoon", "Monday", 1)
    assert (row.is_holiday, row.stops, row.distance_km, row.flight_date) == (0, "zero", 1420.0, "Not specified")


@pytest.mark.parametrize(("flag", "expected"), [(None, 1), (0, 0), (1, 1)])
def test_an_open_holiday_flag_is_looked_up_when_asked(spark, flag, expected):
    row = [tuple({**GOOD, "flight_date": "2025-10-20", "is_holiday": flag}[name] for name in GOOD)]
    asked = spark.createDataFrame(row, schemas.REQUESTS)
    filled = quoting.with_defaults(asked, dims.distances(spark), "2025-06-15", dims.calendar(spark))
    assert filled.first().is_holiday == expected
    assert _filled(spark, flight_date="2025-10-20", is_holiday=None).is_holiday == 0


def test_quick_request_fills_three_fields_and_opens_the_rest(spark):
    row = [tuple({**GOOD, "cabin_class": None, "days_before_departure": None, "departure_time": None}[n] for n in GOOD)]
    quick = quoting.quick_request(spark.createDataFrame(row, schemas.REQUESTS)).first()
    assert (quick.cabin_class, quick.days_before_departure, quick.departure_time) == ("Economy", 30, "Morning")
    assert quick.distance_km is None and quick.flight_date is None and quick.stops is None


def test_stream_equals_batch(spark, data_dir):
    context = inputs.quote_context(spark, data_dir)
    quotes, rejects = quoting.quote(inputs.requests(spark, data_dir), context)
    events = (
        spark.readStream.schema(schemas.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(data_dir)
    )
    path = scratch_path(spark, "stream-test")
    stream = fixtures.requests(events)
    first = scoring.start_quotes(stream, context, f"{path}/quotes", f"{path}/quotes-checkpoint")
    second = scoring.start_rejects(stream, context.names, f"{path}/rejects", f"{path}/rejects-checkpoint")
    first.awaitTermination()
    second.awaitTermination()
    flat = lambda df: sorted(map(str, df.orderBy("request_id").collect()))
    assert flat(spark.read.parquet(f"{path}/quotes")) == flat(quotes)
    assert flat(spark.read.parquet(f"{path}/rejects").select(rejects.columns)) == flat(rejects)
    # A restart from the same checkpoint finds nothing new.
    scoring.start_rejects(stream, context.names, f"{path}/rejects", f"{path}/rejects-checkpoint").awaitTermination()
    assert spark.read.parquet(f"{path}/rejects").count() == rejects.count()


def test_every_rule_is_broken_and_every_default_used(spark, data_dir):
    asked = inputs.requests(spark, data_dir.replace("sf0.001", "sf0.01"))
    checked = validation.with_reasons(asked, inputs.vocabularies(spark, data_dir))
    found = {r[0] for r in checked.select(F.explode("reasons")).distinct().collect()}
    assert len(found) == 18
    kept = validation.accepted(checked)
    for name in ("stops", "is_weekend", "is_holiday", "distance_km"):
        assert kept.where(F.col(name).isNull()).count() and kept.where(F.col(name).isNotNull()).count()
    for name in ("is_weekend", "is_holiday"):
        assert {r[0] for r in kept.select(name).distinct().collect()} == {None, 0, 1}


def test_scoring_both_parts_in_one_stream(spark, data_dir):
    context = inputs.quote_context(spark, data_dir)
    path = scratch_path(spark, "scoring-test")
    events = spark.readStream.schema(schemas.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(data_dir)
    for _ in range(2):  # a restart finds nothing new
        run = scoring.start_scoring(fixtures.requests(events), context, path, f"{path}/checkpoint")
        run.awaitTermination()
    quotes, rejects = quoting.quote(inputs.requests(spark, data_dir), context)
    assert spark.read.parquet(f"{path}/quotes").count() == quotes.count()
    assert spark.read.parquet(f"{path}/rejects").count() == rejects.count()


def test_every_accepted_request_gets_a_quote_in_tens(spark, data_dir):
    context = inputs.quote_context(spark, data_dir)
    asked = inputs.requests(spark, data_dir)
    quotes, rejects = quoting.quote(asked, context)
    assert quotes.count() + rejects.count() == asked.count()
    assert quotes.where(F.col("predicted_price") % 10 != 0).count() == 0
