"""Route popularity: rows per route, relative to the busiest route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.session import stage

SCHEMA = "route string, route_frequency bigint, route_popularity_score double"

# Given to a route the table does not know.
DEFAULT_FREQUENCY = 100
DEFAULT_SCORE = 0.5


def route_counts(flights: DataFrame) -> DataFrame:
    return flights.groupBy("route").agg(F.count("*").alias("route_frequency"))


def popularity_table(flights: DataFrame) -> DataFrame:
    """Route, frequency and score of a flights table."""
    return popularity_of(route_counts(flights))


def popularity_of(counts: DataFrame) -> DataFrame:
    """Route, frequency and score from (route, route_frequency), written once and read by later joins.

    The maximum is a scalar subquery over the small table, never collected.
    """
    counts = stage(counts, "route-counts")
    top = counts.select(F.max("route_frequency")).scalar()
    return counts.withColumn("route_popularity_score", F.col("route_frequency") / top)


def add_popularity(flights: DataFrame, table: DataFrame, fallback: bool = False) -> DataFrame:
    """Attach frequency and score by route; with ``fallback`` unknown routes get the defaults."""
    joined = flights.join(table, "route", "left")
    if not fallback:
        return joined
    return joined.withColumns(
        {
            "route_frequency": F.coalesce("route_frequency", F.lit(DEFAULT_FREQUENCY)),
            "route_popularity_score": F.coalesce("route_popularity_score", F.lit(DEFAULT_SCORE)),
        }
    )
