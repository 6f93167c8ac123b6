"""Fare rules as column expressions: each takes columns and gives a column.

All of them stay inside one projection, so Spark compiles them together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (upper limit in days, value), then the value beyond the last limit.
URGENCY_BANDS = ((3, 5.0), (7, 3.5), (14, 2.0), (30, 1.0), (60, 0.5))
URGENCY_BEYOND = 0.2
ADVANCE_BANDS = ((3, 1.50), (7, 1.30), (14, 1.15), (30, 1.0), (60, 0.90))
ADVANCE_BEYOND = 0.85

# Value by group of months.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Summer": (3, 4, 5), "Monsoon": (6, 7, 8, 9)}
SEASON_OTHER = "Post_Monsoon"
SEASONAL_FACTORS = {1.25: (12, 1), 1.20: (4, 5, 6), 1.30: (10, 11), 1.05: (2, 3, 9), 0.85: (7, 8)}

# Factor by weekday, Monday = 0.
WEEKDAY_FACTORS = {1.20: (4,), 1.25: (5, 6), 1.10: (0,)}

# Stop labels with a count, peak slots, nominal speed, price per km.
STOP_COUNTS = {"zero": 0, "one": 1}
MANY_STOPS = 2
PEAK_SLOTS = ("Morning", "Evening")
CRUISE_KMH = 750.0
PRICE_PER_KM = 3.5

# Price range by class, with the range of every other class last.
PRICE_CAPS = {"Economy": (1500, 25000), "Premium_Economy": (3000, 40000)}
OTHER_CAP = (8000, 60000)
MULTIPLIER_RANGE = (0.3, 1.5)


def banded(value: Column, bands: Sequence[tuple], beyond) -> Column:
    """The value of the first band whose limit is not exceeded; null counts as beyond."""
    chain = F
    for limit, result in bands:
        chain = chain.when(value <= limit, F.lit(result))
    return chain.otherwise(F.lit(beyond))


def mapped(value: Column, groups: dict, other) -> Column:
    """The key of the group that lists the value; null and unlisted values give ``other``."""
    chain = F
    for result, members in groups.items():
        chain = chain.when(value.isin(*members), F.lit(result))
    return chain.otherwise(F.lit(other))


# --- lead time ---------------------------------------------------------------


def booking_urgency(days: Column) -> Column:
    return banded(days, URGENCY_BANDS, URGENCY_BEYOND)


def advance_factor(days: Column) -> Column:
    return banded(days, ADVANCE_BANDS, ADVANCE_BEYOND)


def booking_class(days: Column) -> Column:
    return F.when(days <= 7, "Last_Minute").when(days >= 30, "Advance").otherwise("Normal")


# --- calendar ----------------------------------------------------------------


def season(month: Column) -> Column:
    return mapped(month, SEASON_MONTHS, SEASON_OTHER)


def seasonal_factor(month: Column) -> Column:
    return mapped(month, SEASONAL_FACTORS, 1.0)


def weekday_factor(date: Column) -> Column:
    return mapped(F.weekday(date), WEEKDAY_FACTORS, 1.0)


def quarter_of(month: Column) -> Column:
    return F.floor((month - 1) / 3).cast("int") + 1


def weekend_flag(date: Column) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


# --- flight ------------------------------------------------------------------


def stop_count(stops: Column) -> Column:
    return mapped(stops, {count: (label,) for label, count in STOP_COUNTS.items()}, MANY_STOPS)


def square(value: Column) -> Column:
    return F.pow(value, F.lit(2.0))


def peak_flag(slot: Column) -> Column:
    return mapped(slot, {1: PEAK_SLOTS}, 0)


def class_flag(cabin: Column) -> Column:
    return mapped(cabin, {0.0: ("Economy",)}, 1.0)


def route_key(source: Column, destination: Column, separator: str = "-") -> Column:
    return F.concat(source, F.lit(separator), destination)


def route_label(source: Column, destination: Column) -> Column:
    return route_key(source, destination, " → ")


def nominal_duration(distance: Column) -> Column:
    return distance / F.lit(CRUISE_KMH)


def carrier_prefix(airline: Column) -> Column:
    return F.upper(F.substring(airline, 1, 2))


# --- price -------------------------------------------------------------------


def composed_price(distance: Column, factors: Sequence[Column]) -> Column:
    """Distance times the price per km times each factor, in the given order."""
    price = distance * F.lit(PRICE_PER_KM)
    for factor in factors:
        price = price * factor
    return price


def truncate(value: Column) -> Column:
    """Toward zero."""
    return value.try_cast("int")


def _within(value: Column, low: Column, high: Column) -> Column:
    # greatest/least skip nulls, so a null has to be kept out of them.
    return F.when(value.isNotNull(), F.greatest(F.least(value, high), low))


def cap_price(price: Column, cabin: Column) -> Column:
    """The price brought into the range of its class."""
    low, high = F, F
    for name, (floor, ceiling) in PRICE_CAPS.items():
        low = low.when(cabin == name, F.lit(floor))
        high = high.when(cabin == name, F.lit(ceiling))
    return _within(price, low.otherwise(F.lit(OTHER_CAP[0])), high.otherwise(F.lit(OTHER_CAP[1])))


def price_ratio(price: Column, baseline: Column) -> Column:
    return F.try_divide(price, baseline)


def clamp_multiplier(multiplier: Column) -> Column:
    low, high = MULTIPLIER_RANGE
    return _within(multiplier, F.lit(low), F.lit(high))


def final_price(base: Column, multiplier: Column) -> Column:
    return truncate(base * multiplier)


def round_to_tens(price: Column) -> Column:
    """Half to even: 25 gives 20, 35 gives 40."""
    return F.bround(price / 10) * 10


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted)


# --- requests ----------------------------------------------------------------


def parse_date(text: Column) -> Column:
    """Year-month-day; null when absent, empty or not a date."""
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy-M-d")


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A stable bucket 0..buckets-1 from the key alone: the same after any retry.

    A null key counts as empty text, so that no row is left without a bucket.
    """
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
