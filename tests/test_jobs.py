"""Whole jobs over CSV and JSON files made from the test tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.functions import rules
from farekit.operators import baseline, profile
from farekit.plans import features, jobs, quoting
from farekit.sources import dims, fixtures, readers, schemas, sinks
from farekit.streaming import scoring


@pytest.fixture(scope="module")
def flights(spark, data_dir, tmp_path_factory):
    """The fares in the shape of a flights CSV, with the names of the real dimension tables."""
    path = str(tmp_path_factory.mktemp("flights") / "csv")
    cities = fixtures.fixture_cities(spark, data_dir).select("city", "city_name", "code")
    src = cities.toDF("source_city", "source_name", "source_code")
    dst = cities.toDF("destination_city", "destination_name", "destination_code")
    rows = fixtures.priced_fares(spark, data_dir, "stops").drop("source_code", "destination_code")
    rows = features.calendar_columns(rows.join(src, "source_city").join(dst, "destination_city"))
    made = rows.select(
        F.xxhash64("fare_key").alias("flight_id"),
        "date",
        "airline",
        F.concat(rules.carrier_prefix(F.col("airline")), F.lit("100")).alias("flight_number"),
        F.col("source_name").alias("source_city"),
        "source_code",
        F.col("destination_name").alias("destination_city"),
        "destination_code",
        "departure_time",
        F.col("departure_time").alias("arrival_time"),
        rules.nominal_duration(F.col("distance_km")).alias("duration"),
        "stops",
        "class",
        "distance_km",
        F.col("composed_price").alias("price"),
        "days_before_departure",
        "day_of_week",
        "is_weekend",
        "is_holiday",
        "month",
        "quarter",
        "season",
        rules.booking_class(F.col("days_before_departure")).alias("booking_class"),
        rules.route_label(F.col("source_name"), F.col("destination_name")).alias("route"),
    )
    sinks.write_csv(made, path)
    return readers.read_typed_csv(spark, path, schemas.FLIGHTS)


def test_report(spark, flights, tmp_path):
    out = str(tmp_path / "report")
    jobs.report(flights, out)
    read = lambda name: readers.read_untyped_csv(spark, f"{out}/{name}")
    n = flights.count()
    summary = read("summary").first()
    assert int(summary.total_flights) == n
    assert float(summary.avg_flights_per_day) == pytest.approx(n / 365)
    assert sum(int(r.n) for r in read("airlines").collect()) == n
    assert sum(float(r.share) for r in read("classes").collect()) == pytest.approx(1)
    assert read("top_routes").count() == 10 and read("peak_days").count() == 5
    assert float(read("median_price").first().median) == flights.agg(F.median("price")).first()[0]


def test_header_in_another_order_is_refused(spark, tmp_path):
    path = str(tmp_path / "swapped")
    sinks.write_csv(spark.createDataFrame([(1, "f")], "days_left int, flight string"), path)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_typed_csv(spark, path, "flight string, days_left int").collect()


@pytest.fixture(scope="module")
def trained(spark, flights, tmp_path_factory):
    """Trained on flights of which some lack a feature."""
    out = str(tmp_path_factory.mktemp("trained"))
    holes = F.when(F.col("flight_id") % 50 != 0, F.col("distance_km"))
    jobs.train_fares(flights.withColumn("distance_km", holes), out, "2025-01-01", maxIter=3)
    return out


def test_incomplete_rows_are_reported_and_not_counted_as_trained(spark, flights, trained):
    dropped = readers.read_untyped_csv(spark, f"{trained}/dropped").first()
    missing = flights.where(F.col("flight_id") % 50 == 0).count()
    assert (int(dropped.kept_rows), int(dropped.dropped_rows)) == (flights.count() - missing, missing) and missing
    metadata = readers.read_metadata(spark, f"{trained}/metadata", pretty=True).first()
    assert metadata.total_flights_trained < int(dropped.kept_rows)


def test_training_writes_what_quoting_needs(spark, flights, trained):
    metadata = readers.read_metadata(spark, f"{trained}/metadata", pretty=True).first()
    assert metadata.valid_airlines == sorted(fixtures.FIXTURE_AIRLINES)
    assert metadata.valid_cities == sorted({r[0] for r in flights.select("source_city").union(flights.select("destination_city")).collect()})
    assert 0 < metadata.total_flights_trained < flights.count()
    names = {r.source for r in readers.read_untyped_csv(spark, f"{trained}/importances").collect()}
    assert names == {*features.CATEGORICAL, *features.NUMERIC}
    status = quoting.status(readers.read_metadata(spark, f"{trained}/metadata", pretty=True)).first()
    assert status.valid_airlines_count == 6 and status.rmse_text.startswith("₹")


def test_batch_and_stream_quotes_agree(spark, trained, tmp_path):
    rows = [
        (1, "SMALL", "Kolkata", "Jaipur", "Afternoon", "Economy", 21, None, 1345.0, None, None, None),
        (2, "PROMO", "Goa", "Mumbai", "Night", "Premium_Economy", 12, "2025-11-15", None, "one", 0, 1),
        (3, "PROMO", "Delhi", "Delhi", "Evening", "First", 97, "someday", 50.0, None, None, None),
    ]
    spark.createDataFrame(rows, schemas.REQUESTS).write.json(str(tmp_path / "asked"))
    context = jobs.load_context(spark, trained, "2025-06-15")
    jobs.quote_requests(readers.read_json_requests(spark, str(tmp_path / "asked")), context, str(tmp_path / "batch"))
    jobs.quote_requests(readers.stream_requests(spark, str(tmp_path / "asked")), context, str(tmp_path / "stream"))
    for part in ("quotes", "rejects"):
        batch, stream = (spark.read.parquet(str(tmp_path / kind / part)) for kind in ("batch", "stream"))
        assert sorted(map(str, batch.collect())) == sorted(map(str, stream.select(batch.columns).collect()))
    quotes = {r.request_id: r for r in spark.read.parquet(str(tmp_path / "batch" / "quotes")).collect()}
    assert set(quotes) == {1, 2}
    assert quotes[2].flight_details.route == "Goa → Mumbai"
    assert quotes[2].flight_details.distance_km == 440.0
    assert quotes[2].flight_details.is_weekend and quotes[2].flight_details.is_holiday
    reject = spark.read.parquet(str(tmp_path / "batch" / "rejects")).first()
    assert reject.reasons == [
        "bad_cabin_class", "bad_flight_date", "days_before_departure_out_of_range", "distance_km_out_of_range", "same_city",
    ]


@pytest.mark.parametrize("preset", ["notebook", "stored"])
def test_multiplier_job(spark, data_dir, tmp_path, preset):
    quotes_csv = str(tmp_path / "quotes")
    sinks.write_csv(fixtures.quotes(spark, data_dir), quotes_csv)
    quotes = readers.read_typed_csv(spark, quotes_csv, schemas.QUOTES)
    # The one-hot class of the stored model only knows labels it was fitted on.
    quotes = quotes.where("classx <> 'Premium_Economy'")
    jobs.fit_multiplier(quotes, str(tmp_path / "out"), preset, maxIter=3)
    scenarios = readers.read_untyped_csv(spark, str(tmp_path / "out" / "scenarios"))
    assert scenarios.count() == 8 * baseline.baseline_prices(quotes).count()
    ratios = readers.read_untyped_csv(spark, str(tmp_path / "out" / "ratios"))
    assert ratios.count() == profile.stats_by(baseline.with_ratio(quotes), "price_ratio", ["days_left", "classx"]).count()


def test_real_calendar_is_keyed_by_date(spark):
    days = spark.createDataFrame([("2025-10-20",), ("2024-10-20",)], "d string").selectExpr("CAST(d AS date) AS date")
    from farekit.operators import pricing

    found = {str(r.date): (r.holiday, r.holiday_boost, r.is_holiday) for r in pricing.add_holiday(days, dims.calendar(spark)).collect()}
    assert found == {"2025-10-20": ("Diwali", 1.5, 1), "2024-10-20": (None, 1.0, 0)}


def test_training_features_cover_the_model(spark, data_dir):
    missing = {*features.CATEGORICAL, *features.NUMERIC} - set(inputs.training_features(spark, data_dir).columns)
    assert missing == {"route_popularity_score"}


def test_a_failed_second_sink_loses_and_repeats_nothing(spark, trained, tmp_path, monkeypatch):
    rows = [
        (i, "SMALL" if i % 3 else "NOBODY", "Kolkata", "Jaipur", "Afternoon", "Economy", i % 100, None, 1345.0, None, None, None)
        for i in range(200)
    ]
    asked = spark.createDataFrame(rows, schemas.REQUESTS)
    for part in range(2):
        asked.where(F.col("request_id") % 2 == part).coalesce(1).write.mode("append").json(str(tmp_path / "asked"))
    context = jobs.load_context(spark, trained, "2025-06-15")
    stream = lambda: readers.stream_requests(spark, str(tmp_path / "asked"))
    out = str(tmp_path / "out")

    write = scoring._replace

    def broken(rows, path):
        if "/rejects/" in path:
            raise OSError("the disk of the rejects is full")
        write(rows, path)

    with monkeypatch.context() as patch:
        patch.setattr(scoring, "_replace", broken)
        with pytest.raises(Exception, match="rejects is full"):
            jobs.quote_requests(stream(), context, out)
    # The quotes of the failed attempt are there, its rejects are not.
    assert spark.read.parquet(f"{out}/quotes").count() > 0 and not (tmp_path / "out" / "rejects").exists()
    jobs.quote_requests(stream(), context, out)
    jobs.quote_requests(stream(), context, out)
    jobs.quote_requests(readers.read_json_requests(spark, str(tmp_path / "asked")), context, str(tmp_path / "batch"))
    for part in ("quotes", "rejects"):
        once = spark.read.parquet(str(tmp_path / "batch" / part))
        streamed = spark.read.parquet(f"{out}/{part}").select(once.columns)
        assert sorted(map(str, streamed.collect())) == sorted(map(str, once.collect())) and once.count()
