"""Model features of flights: one projection per dependency layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.functions import rules

# The inputs of the stored model, in its order.
CATEGORICAL = ("airline", "source_city", "destination_city", "departure_time", "class", "season", "day_of_week")
NUMERIC = (
    "distance_km",
    "distance_squared",
    "duration",
    "stop_count",
    "days_before_departure",
    "booking_urgency_score",
    "is_weekend",
    "is_holiday",
    "month",
    "quarter",
    "is_peak_time",
    "route_popularity_score",
)


def calendar_columns(df: DataFrame) -> DataFrame:
    """Month, quarter, season, day name and weekend flag of ``date``."""
    date, month = F.col("date"), F.month("date")
    return df.withColumns(
        {
            "month": month,
            "quarter": rules.quarter_of(month),
            "season": rules.season(month),
            "day_of_week": rules.day_name(date),
            "is_weekend": rules.weekend_flag(date),
        }
    )


def engineered_columns(df: DataFrame) -> DataFrame:
    """The derived features, with the inputs cast to their model types."""
    typed = {
        "distance_km": F.col("distance_km").try_cast("double"),
        "duration": F.col("duration").try_cast("double"),
        "days_before_departure": F.col("days_before_departure").try_cast("int"),
        **{name: F.col(name).try_cast("int") for name in ("is_weekend", "is_holiday", "month", "quarter")},
    }
    derived = {
        "distance_squared": rules.square(F.col("distance_km")),
        "stop_count": rules.stop_count(F.col("stops")),
        "booking_urgency_score": rules.booking_urgency(F.col("days_before_departure")),
        "is_peak_time": rules.peak_flag(F.col("departure_time")),
        "route": rules.route_key(F.col("source_city"), F.col("destination_city")),
    }
    return df.withColumns(typed).withColumns(derived)
