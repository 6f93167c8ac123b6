"""Dimension tables with fixed content.

Each table is an inline ``VALUES`` relation, so the optimizer knows its exact
size and broadcasts it without a hint. None of them grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from pyspark.sql import DataFrame, SparkSession

# Carriers (name, multiplier).
AIRLINES = (
    ("IndiGo", 0.95),
    ("Air_India", 1.05),
    ("SpiceJet", 0.90),
    ("Vistara", 1.20),
    ("AirAsia_India", 0.88),
    ("Akasa_Air", 0.92),
)

# Cities (name, code, demand, tier).
CITIES = (
    ("Delhi", "DEL", 1.3, 1),
    ("Mumbai", "BOM", 1.3, 1),
    ("Bangalore", "BLR", 1.25, 1),
    ("Hyderabad", "HYD", 1.15, 1),
    ("Chennai", "MAA", 1.15, 1),
    ("Kolkata", "CCU", 1.1, 1),
    ("Pune", "PNQ", 1.05, 2),
    ("Ahmedabad", "AMD", 1.05, 2),
    ("Goa", "GOI", 1.0, 2),
    ("Jaipur", "JAI", 0.95, 2),
    ("Kochi", "COK", 0.95, 2),
    ("Chandigarh", "IXC", 0.9, 3),
    ("Lucknow", "LKO", 0.9, 3),
    ("Srinagar", "SXR", 0.85, 3),
    ("Varanasi", "VNS", 0.85, 3),
    ("Indore", "IDR", 0.88, 3),
    ("Nagpur", "NAG", 0.85, 3),
    ("Coimbatore", "CJB", 0.82, 3),
    ("Patna", "PAT", 0.80, 3),
    ("Bhubaneswar", "BBI", 0.80, 3),
)

# Departure slots (name, multiplier).
SLOTS = (
    ("Early_Morning", 0.90),
    ("Morning", 1.05),
    ("Afternoon", 1.0),
    ("Evening", 1.15),
    ("Night", 0.95),
)

# Cabin classes (name, multiplier, lowest price, highest price).
CLASSES = (
    ("Economy", 1.0, 1500, 25000),
    ("Premium_Economy", 1.8, 3000, 40000),
    ("Business", 3.5, 8000, 60000),
)

# Holidays (date, name, price boost).
HOLIDAYS = (
    ("2025-01-01", "New Year", 1.4),
    ("2025-01-14", "Makar Sankranti", 1.25),
    ("2025-01-26", "Republic Day", 1.3),
    ("2025-03-14", "Holi", 1.35),
    ("2025-03-30", "Eid ul-Fitr", 1.3),
    ("2025-04-10", "Ram Navami", 1.2),
    ("2025-04-14", "Ambedkar Jayanti", 1.15),
    ("2025-04-18", "Good Friday", 1.2),
    ("2025-05-01", "May Day", 1.1),
    ("2025-06-06", "Eid ul-Adha", 1.3),
    ("2025-08-15", "Independence Day", 1.3),
    ("2025-08-27", "Janmashtami", 1.2),
    ("2025-10-02", "Gandhi Jayanti", 1.25),
    ("2025-10-12", "Dussehra", 1.4),
    ("2025-10-20", "Diwali", 1.5),
    ("2025-10-21", "Diwali", 1.5),
    ("2025-12-25", "Christmas", 1.35),
)

# Known distances in km, valid in both directions.
DISTANCES = (
    ("Delhi", "Mumbai", 1150),
    ("Delhi", "Bangalore", 1760),
    ("Delhi", "Chennai", 1760),
    ("Delhi", "Kolkata", 1320),
    ("Mumbai", "Bangalore", 850),
    ("Mumbai", "Goa", 440),
    ("Bangalore", "Goa", 520),
    ("Delhi", "Goa", 1420),
    ("Chennai", "Bangalore", 290),
    ("Mumbai", "Chennai", 1030),
)

# Tourist routes (source, destination, km, multiplier).
TOURIST_ROUTES = (
    ("Mumbai", "Goa", 440, 1.1),
    ("Delhi", "Srinagar", 660, 1.15),
    ("Bangalore", "Goa", 520, 1.1),
    ("Delhi", "Varanasi", 680, 1.0),
    ("Bangalore", "Kochi", 490, 1.05),
    ("Mumbai", "Jaipur", 920, 1.05),
    ("Chennai", "Coimbatore", 340, 0.95),
    ("Delhi", "Lucknow", 500, 0.95),
    ("Mumbai", "Indore", 590, 1.0),
)

# Multiplier of routes by the tiers they link.
METRO_ROUTE = (1.0,)
REGIONAL_ROUTE = (0.95,)

# Stop labels and season labels in listing order.
STOPS = ("zero", "one", "two_or_more")
SEASONS = ("Winter", "Summer", "Monsoon", "Post_Monsoon")

SLOT_NAMES = tuple(row[0] for row in SLOTS)
CLASS_NAMES = tuple(row[0] for row in CLASSES)


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value!r}e0" if isinstance(value, float) else str(value)


def values_sql(rows: Sequence[tuple], columns: Sequence[str], alias: str) -> str:
    """``(VALUES ...) AS alias(columns)``; floats are written as doubles."""
    body = ", ".join("(" + ", ".join(map(_sql_literal, row)) + ")" for row in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(columns)})"


def values_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    return spark.sql(f"SELECT * FROM {values_sql(rows, columns, 'dim')}")


def airlines(spark: SparkSession) -> DataFrame:
    return values_table(spark, AIRLINES, ("airline", "airline_multiplier"))


def cities(spark: SparkSession) -> DataFrame:
    return values_table(spark, CITIES, ("city", "code", "demand", "tier"))


def slots(spark: SparkSession) -> DataFrame:
    return values_table(spark, SLOTS, ("departure_time", "slot_multiplier"))


def classes(spark: SparkSession) -> DataFrame:
    return values_table(spark, CLASSES, ("class", "class_multiplier", "cap_low", "cap_high"))


def calendar(spark: SparkSession) -> DataFrame:
    """Holidays by date."""
    raw = values_table(spark, HOLIDAYS, ("date", "holiday", "holiday_boost"))
    return raw.selectExpr("CAST(date AS date) AS date", "holiday", "holiday_boost")


def yearly_calendar(spark: SparkSession) -> DataFrame:
    """The same holidays by month and day, for tables that span many years."""
    return calendar(spark).selectExpr(
        "month(date) AS holiday_month", "day(date) AS holiday_day", "holiday", "holiday_boost"
    )


def distances(spark: SparkSession) -> DataFrame:
    """Known distances keyed by the alphabetically ordered pair of cities."""
    raw = values_table(spark, DISTANCES, ("city_x", "city_y", "km"))
    return raw.selectExpr(
        "least(city_x, city_y) AS city_a", "greatest(city_x, city_y) AS city_b", "CAST(km AS double) AS known_km"
    )


def route_rows() -> tuple[tuple, ...]:
    """(route_id, source, destination, km, multiplier) of all routes.

    The tourist routes repeat pairs of cities under other attributes, so a pair
    is not a key.
    """
    metros = [name for name, _, _, tier in CITIES if tier == 1]
    others = [name for name, _, _, tier in CITIES if tier > 1]
    links = [(a, b, None, *METRO_ROUTE) for a, b in combinations(metros, 2)]
    links += [(a, b, None, *REGIONAL_ROUTE) for a, b in product(metros, others)]
    return tuple((i, *link) for i, link in enumerate((*links, *TOURIST_ROUTES), 1))


ROUTE_COLUMNS = ("route_id", "source_city", "destination_city", "route_km", "route_multiplier")


def routes(spark: SparkSession) -> DataFrame:
    """All routes; ``route_km`` is null where no fixed distance is known. Join by ``route_id``."""
    return values_table(spark, route_rows(), ROUTE_COLUMNS)
