"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.catalog.registry import query
from farekit.catalog.views import ROUTES, with_checked, with_distances, with_fares, with_priced, with_quotes
from farekit.operators import baseline, lookup, popularity, pricing, profile
from farekit.sources import dims, fixtures

_BASELINE_SQL = """(SELECT flight, avg(price) AS baseline_price FROM quotes WHERE days_left = 1 GROUP BY flight)"""


@query(
    "j01_baseline_join",
    with_quotes(f"""
SELECT fare_key, flight, days_left, classx, price, round(baseline_price, 6) AS baseline_price
FROM quotes JOIN {_BASELINE_SQL} b USING (flight)"""),
)
def j01(spark, sf_dir):
    rows = baseline.with_baseline(fixtures.quotes(spark, sf_dir, "fare_key"))
    return rows.withColumn("baseline_price", F.round("baseline_price", 6))


_ROUTES_SQL = """(SELECT source_city || '-' || destination_city AS route, count(*) AS route_frequency
  FROM fares GROUP BY 1)"""


@query(
    "j02_popularity_join",
    with_fares(f"""
SELECT fare_key, r.route, route_frequency
FROM fares LEFT JOIN {_ROUTES_SQL} r ON r.route = source_city || '-' || destination_city"""),
)
def j02(spark, sf_dir):
    rows = inputs.routed_fares(spark, sf_dir, "fare_key")
    table = popularity.popularity_table(rows)
    return popularity.add_popularity(rows, table).select("fare_key", "route", "route_frequency")


@query(
    "j03_scalar_join",
    with_fares(f"""
SELECT route, route_frequency, (SELECT max(route_frequency) FROM {_ROUTES_SQL} m) AS max_route_frequency
FROM {_ROUTES_SQL} r"""),
)
def j03(spark, sf_dir):
    counts = popularity.route_counts(inputs.routed_fares(spark, sf_dir))
    return counts.withColumn("max_route_frequency", counts.select(F.max("route_frequency")).scalar())


@query(
    "j04_distance_lookup",
    with_distances("""
SELECT request_id, source_city, destination_city, coalesce(km, 1000.0e0) AS lookup_km
FROM requests LEFT JOIN distance_dim
  ON ka = least(source_city, destination_city) AND kb = greatest(source_city, destination_city)"""),
)
def j04(spark, sf_dir):
    found = lookup.distance_between(
        inputs.requests(spark, sf_dir),
        fixtures.fixture_distances(spark, sf_dir),
        F.col("source_city"),
        F.col("destination_city"),
    )
    return found.select("request_id", "source_city", "destination_city", "lookup_km")


_J5 = (
    "fare_key", "airline_multiplier", "route_multiplier", "slot_multiplier", "class_multiplier",
    "source_code", "source_demand", "source_tier", "destination_code", "destination_demand", "destination_tier",
)


@query("j05_dimension_lookups", with_priced(f"SELECT {', '.join(_J5)} FROM factors"))
def j05(spark, sf_dir):
    return fixtures.priced_fares(spark, sf_dir).select(*_J5)


@query(
    "j05_route_lookup",
    with_fares(f"""
SELECT fare_key, f.source_city, f.destination_city, f.route_id, CAST(route_km AS INTEGER) AS route_km,
       CAST(route_multiplier AS DOUBLE) AS route_multiplier
FROM fares f LEFT JOIN {ROUTES} ON route_table.route_id = f.route_id"""),
)
def j05_route(spark, sf_dir):
    """Attributes of a fare's route by its id; a pair of cities may stand for several routes."""
    rows = fixtures.fares(spark, sf_dir, "fare_key", "source_city", "destination_city", "route_id")
    return pricing.add_route(rows, dims.routes(spark))


@query("j06_calendar_lookup", with_priced("SELECT fare_key, date, holiday, holiday_boost, is_holiday FROM factors"))
def j06(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key", "date")
    return pricing.add_holiday(rows, dims.yearly_calendar(spark))


@query(
    "j07_known_requests",
    with_checked("SELECT request_id, airline FROM flagged WHERE airline IS NOT NULL AND NOT unknown_airline"),
)
def j07_known(spark, sf_dir):
    names = inputs.vocabularies(spark, sf_dir)
    rows = inputs.requests(spark, sf_dir).select("request_id", "airline")
    return lookup.known_only(rows, names.airlines, "airline")


@query(
    "j07_unknown_requests",
    with_checked("SELECT request_id, airline FROM flagged WHERE airline IS NULL OR unknown_airline"),
)
def j07_unknown(spark, sf_dir):
    names = inputs.vocabularies(spark, sf_dir)
    rows = inputs.requests(spark, sf_dir).select("request_id", "airline")
    return lookup.unknown_only(rows, names.airlines, "airline")


_BUSIEST_SQL = """
SELECT date, dayname(date) AS day_of_week, count(*) AS n,
       coalesce(max(holiday), CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE '' END) AS label
FROM factors GROUP BY date"""


@query("j08_day_attributes", with_priced(_BUSIEST_SQL))
def j08(spark, sf_dir):
    rows = pricing.add_holiday(fixtures.fares(spark, sf_dir, "date"), dims.yearly_calendar(spark))
    return profile.days(rows)


@query("o05_top_days", with_priced(_BUSIEST_SQL + " ORDER BY n DESC, date LIMIT 5"))
def o05(spark, sf_dir):
    rows = pricing.add_holiday(fixtures.fares(spark, sf_dir, "date"), dims.yearly_calendar(spark))
    return profile.busiest_days(rows, 5)


@query(
    "j09_scenario_grid",
    with_quotes(f"""
SELECT flight, round(baseline_price, 6) AS baseline_price, days_left, classx
FROM {_BASELINE_SQL} b, (VALUES (1), (5), (10), (20)) AS d(days_left), (VALUES ('Economy'), ('Business')) AS c(classx)"""),
)
def j09(spark, sf_dir):
    bases = baseline.baseline_prices(fixtures.quotes(spark, sf_dir))
    grid = baseline.scenario_grid(bases, [1, 5, 10, 20], ["Economy", "Business"])
    return grid.withColumn("baseline_price", F.round("baseline_price", 6))
