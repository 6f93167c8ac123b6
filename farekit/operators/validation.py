"""Request validation: every reason for rejection, as an array per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.functions import rules
from farekit.operators import lookup
from farekit.session import stage
from farekit.sources import dims, schemas

REQUIRED = ("airline", "source_city", "destination_city", "departure_time", "cabin_class", "days_before_departure")

UNREADABLE = "unreadable"

# Allowed ranges and lists.
RANGES = {
    "days_before_departure": (0, 90),
    "distance_km": (100, 3000),
    "is_weekend": (0, 1),
    "is_holiday": (0, 1),
}
LISTS = {"departure_time": dims.SLOT_NAMES, "cabin_class": dims.CLASS_NAMES, "stops": dims.STOPS}


class Vocabularies:
    """The known airlines and cities, written once so that their true size is known."""

    def __init__(self, airlines: DataFrame, cities: DataFrame):
        self.airlines = airlines
        self.cities = cities

    @classmethod
    def of(cls, flights: DataFrame) -> Vocabularies:
        """From one pass over a flights table. Cities keep the roles they were seen in."""
        kinds = {"airline": "airline", "source": "source_city", "destination": "destination_city"}
        seen = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("name")) for kind, c in kinds.items()])
        found = flights.select(F.explode(seen).alias("seen")).select("seen.*").where(F.col("name").isNotNull())
        # Aggregated before the shuffle, so that a frequent name is one row per task.
        was = lambda kind: F.bool_or(F.col("kind") == kind)
        names = stage(
            found.groupBy("name").agg(
                was("airline").alias("as_airline"),
                was("source").alias("as_source"),
                was("destination").alias("as_destination"),
            ),
            "names",
        )
        airlines = names.where("as_airline").select(F.col("name").alias("airline"))
        cities = names.where("as_source OR as_destination")
        return cls(airlines, cities.select(F.col("name").alias("city"), "as_source", "as_destination"))

    @classmethod
    def from_metadata(cls, metadata: DataFrame) -> Vocabularies:
        """From the stored metadata record of a model."""
        return cls(
            metadata.select(F.explode("valid_airlines").alias("airline")),
            metadata.select(F.explode("valid_cities").alias("city")),
        )

    @property
    def city_names(self) -> DataFrame:
        return self.cities.select("city")


def mark_names(requests: DataFrame, names: Vocabularies) -> DataFrame:
    """Attach ``airline_known``, ``source_known`` and ``destination_known``."""
    df = lookup.mark_known(requests, names.airlines, "airline", "airline_known")
    df = lookup.mark_known(df, names.city_names, "source_city", "source_known")
    return lookup.mark_known(df, names.city_names, "destination_city", "destination_known")


def _reasons():
    """Reason by condition. A null value breaks only the required-field rule."""
    given = lambda name: F.col(name).isNotNull()
    yield "unknown_airline", given("airline") & ~F.col("airline_known")
    yield "unknown_source_city", given("source_city") & ~F.col("source_known")
    yield "unknown_destination_city", given("destination_city") & ~F.col("destination_known")
    yield "same_city", F.col("source_city") == F.col("destination_city")
    for name, (low, high) in RANGES.items():
        yield f"{name}_out_of_range", ~F.col(name).between(low, high)
    for name, allowed in LISTS.items():
        yield f"bad_{name}", ~F.col(name).isin(*allowed)
    for name in REQUIRED:
        yield f"missing_{name}", F.col(name).isNull()
    date_given = F.nullif(F.col("flight_date"), F.lit("")).isNotNull()
    yield "bad_flight_date", date_given & rules.parse_date(F.col("flight_date")).isNull()


def with_reasons(requests: DataFrame, names: Vocabularies) -> DataFrame:
    """Requests with ``reasons``, the sorted array of all broken rules.

    A request that was read as text only has one reason, that it is unreadable:
    what its fields are is not known.
    """
    marked = mark_names(requests, names)
    found = F.array(*[F.when(broken, F.lit(reason)) for reason, broken in _reasons()])
    reasons = F.array_sort(F.array_compact(found))
    if schemas.UNREADABLE in requests.columns:
        reasons = F.when(F.col(schemas.UNREADABLE).isNotNull(), F.array(F.lit(UNREADABLE))).otherwise(reasons)
    return marked.withColumn("reasons", reasons).drop("airline_known", "source_known", "destination_known")


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons", schemas.UNREADABLE)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def option_listing(names: Vocabularies) -> DataFrame:
    """``(kind, value)`` rows of everything a request may choose from."""
    spark = names.airlines.sparkSession
    fixed = [
        *[("departure_time", name) for name in dims.SLOT_NAMES],
        *[("cabin_class", name) for name in dims.CLASS_NAMES],
        *[("stops", name) for name in dims.STOPS],
        *[("season", name) for name in dims.SEASONS],
    ]
    return (
        names.airlines.select(F.lit("airline").alias("kind"), F.col("airline").alias("value"))
        .union(names.cities.select(F.lit("city").alias("kind"), F.col("city").alias("value")))
        .union(dims.values_table(spark, fixed, ("kind", "value")))
    )
