"""Price composition: dimension lookups, calendar lookup and the factor product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.functions import rules

# The order of the product. Doubles are not associative, so it is fixed.
FACTOR_ORDER = (
    "airline_multiplier",
    "route_multiplier",
    "slot_multiplier",
    "class_multiplier",
    "seasonal_factor",
    "weekday_factor",
    "advance_factor",
    "holiday_boost",
    "source_demand",
    "destination_demand",
)


def add_city_role(df: DataFrame, cities: DataFrame, role: str) -> DataFrame:
    """Attach the city attributes under a role prefix, for ``<role>_city``."""
    renamed = cities.select(*[F.col(c).alias(f"{role}_{c}") for c in cities.columns])
    return df.join(renamed, f"{role}_city", "left")


def add_holiday(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Attach holiday name, boost (1.0 on other days) and flag.

    ``calendar`` is keyed by ``date``, or by ``holiday_month`` and ``holiday_day``
    when the holidays repeat every year.
    """
    if "date" in calendar.columns:
        joined = df.join(calendar, "date", "left")
    else:
        same_day = (F.month("date") == F.col("holiday_month")) & (F.day("date") == F.col("holiday_day"))
        joined = df.join(calendar, same_day, "left").drop("holiday_month", "holiday_day")
    return joined.withColumns(
        {
            "holiday_boost": F.coalesce("holiday_boost", F.lit(1.0)),
            "is_holiday": F.col("holiday").isNotNull().cast("int"),
        }
    )


def add_route(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Attach the attributes of a route by ``route_id``, never by its pair of cities."""
    return df.join(routes.drop("source_city", "destination_city"), "route_id", "left")


def add_factors(
    flights: DataFrame,
    airlines: DataFrame,
    cities: DataFrame,
    slots: DataFrame,
    classes: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    """Attach every multiplier except the route's, whose key the caller knows."""
    df = flights.join(airlines.select("airline", "airline_multiplier"), "airline", "left")
    df = df.join(slots.select("departure_time", "slot_multiplier"), "departure_time", "left")
    df = df.join(classes.select("class", "class_multiplier"), "class", "left")
    df = add_city_role(add_city_role(df, cities, "source"), cities, "destination")
    return add_holiday(df, calendar).withColumns(
        {
            "seasonal_factor": rules.seasonal_factor(F.month("date")),
            "weekday_factor": rules.weekday_factor(F.col("date")),
            "advance_factor": rules.advance_factor(F.col("days_before_departure")),
        }
    )


def add_rule_price(factors: DataFrame) -> DataFrame:
    """The factor product ``rule_price``, and ``composed_price``: truncated, then capped by class."""
    product = rules.composed_price(F.col("distance_km"), [F.col(name) for name in FACTOR_ORDER])
    composed = rules.cap_price(rules.truncate(F.col("rule_price")), F.col("class"))
    return factors.withColumn("rule_price", product).withColumn("composed_price", composed)
