"""Scalar rules, one query each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.catalog.joins import _BASELINE_SQL, _ROUTES_SQL
from farekit.catalog.projections import _SEASON_SQL, _URGENCY_SQL
from farekit.catalog.registry import query
from farekit.catalog.views import AS_OF_DATE, with_fares, with_filled, with_priced, with_quotes, with_requests
from farekit.functions import rules, texts
from farekit.operators import baseline, popularity, validation
from farekit.plans import quoting
from farekit.sources import fixtures


def _fare_rule(name: str, needs: tuple[str, ...], sql: str, **made):
    """Register a query that gives the needed fares columns and rule columns of each fare."""
    columns = ("fare_key", *needs)

    @query(name, with_fares(f"SELECT {', '.join(columns)}, {sql} FROM fares"))
    def run(spark, sf_dir):
        return fixtures.fares(spark, sf_dir, *columns).withColumns({k: make() for k, make in made.items()})

    return run


def _col(name: str) -> Column:
    return F.col(name)


_LEAD = ("days_before_departure",)

_fare_rule(
    "f01_booking_urgency", _LEAD, f"{_URGENCY_SQL} AS urgency",
    urgency=lambda: rules.booking_urgency(_col("days_before_departure")),
)
_fare_rule(
    "f02_stop_count", ("stops",),
    "CAST(CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 ELSE 2 END AS INTEGER) AS stop_count",
    stop_count=lambda: rules.stop_count(_col("stops")),
)
_fare_rule(
    "f03_square", ("distance_km",), "distance_km * distance_km AS distance_squared",
    distance_squared=lambda: rules.square(_col("distance_km")),
)
_fare_rule(
    "f04_peak_flag", ("departure_time",),
    "CAST(CASE WHEN departure_time IN ('Morning', 'Evening') THEN 1 ELSE 0 END AS INTEGER) AS is_peak_time",
    is_peak_time=lambda: rules.peak_flag(_col("departure_time")),
)
_fare_rule(
    "f05_class_flag", ("class",), "CASE class WHEN 'Economy' THEN 0.0e0 ELSE 1.0e0 END AS class_numeric",
    class_numeric=lambda: rules.class_flag(_col("class")),
)
_fare_rule(
    "f06_route_key", ("source_city", "destination_city"),
    "source_city || '-' || destination_city AS route, source_city || ' → ' || destination_city AS route_label",
    route=lambda: rules.route_key(_col("source_city"), _col("destination_city")),
    route_label=lambda: rules.route_label(_col("source_city"), _col("destination_city")),
)
_fare_rule("f07_season", ("date",), f"{_SEASON_SQL} AS season", season=lambda: rules.season(F.month("date")))
_fare_rule(
    "f08_seasonal_factor", ("date",),
    """CASE WHEN month(date) IN (12, 1) THEN 1.25e0 WHEN month(date) IN (4, 5, 6) THEN 1.2e0
         WHEN month(date) IN (10, 11) THEN 1.3e0 WHEN month(date) IN (7, 8) THEN 0.85e0 ELSE 1.05e0 END AS factor""",
    factor=lambda: rules.seasonal_factor(F.month("date")),
)
_fare_rule(
    "f09_weekday_factor", ("date",),
    """CASE dayname(date) WHEN 'Friday' THEN 1.2e0 WHEN 'Saturday' THEN 1.25e0 WHEN 'Sunday' THEN 1.25e0
         WHEN 'Monday' THEN 1.1e0 ELSE 1.0e0 END AS factor""",
    factor=lambda: rules.weekday_factor(_col("date")),
)
_fare_rule(
    "f10_advance_factor", _LEAD,
    """CASE WHEN days_before_departure <= 3 THEN 1.5e0 WHEN days_before_departure <= 7 THEN 1.3e0
         WHEN days_before_departure <= 14 THEN 1.15e0 WHEN days_before_departure <= 30 THEN 1.0e0
         WHEN days_before_departure <= 60 THEN 0.9e0 ELSE 0.85e0 END AS factor""",
    factor=lambda: rules.advance_factor(_col("days_before_departure")),
)
_fare_rule(
    "f11_booking_class", _LEAD,
    """CASE WHEN days_before_departure <= 7 THEN 'Last_Minute' WHEN days_before_departure >= 30 THEN 'Advance'
         ELSE 'Normal' END AS booking_class""",
    booking_class=lambda: rules.booking_class(_col("days_before_departure")),
)
_fare_rule(
    "f12_quarter", ("date",), "CAST(quarter(date) AS INTEGER) AS quarter",
    quarter=lambda: rules.quarter_of(F.month("date")),
)
_fare_rule(
    "f13_weekend_flag", ("date",), "CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend",
    is_weekend=lambda: rules.weekend_flag(_col("date")),
)
_fare_rule(
    "f14_month_and_day_name", ("date",), "CAST(month(date) AS INTEGER) AS month, dayname(date) AS day_of_week",
    month=lambda: F.month("date"), day_of_week=lambda: rules.day_name(_col("date")),
)
_fare_rule(
    "f15_nominal_duration", ("distance_km",), "round(distance_km / 750.0e0, 6) AS duration",
    duration=lambda: F.round(rules.nominal_duration(_col("distance_km")), 6),
)
_fare_rule(
    "f17_truncate", ("price",), "CAST(trunc(price) AS INTEGER) AS whole_price",
    whole_price=lambda: rules.truncate(_col("price")),
)
_fare_rule(
    "f18_price_cap", ("class", "price"),
    """greatest(least(price, CASE class WHEN 'Economy' THEN 25000 WHEN 'Premium_Economy' THEN 40000 ELSE 60000 END),
         CASE class WHEN 'Economy' THEN 1500 WHEN 'Premium_Economy' THEN 3000 ELSE 8000 END) AS capped_price""",
    capped_price=lambda: rules.cap_price(_col("price"), _col("class")),
)
_fare_rule(
    "f19_carrier_prefix", ("airline",), "upper(substr(airline, 1, 2)) AS prefix",
    prefix=lambda: rules.carrier_prefix(_col("airline")),
)
_fare_rule(
    "f25_round_to_tens", ("price",), "round_even(price / 10, 0) * 10 AS rounded_price",
    rounded_price=lambda: rules.round_to_tens(_col("price")),
)
_fare_rule(
    "f26_booking_insight", ("days_before_departure", "price"),
    """CASE WHEN days_before_departure <= 3 THEN '🔴 Last minute booking! Prices are '
           || CAST(CAST(round_even(round_even(price / 10, 0) * 10 * 0.4e0, 0) AS BIGINT) AS VARCHAR)
           || ' higher than average.'
         WHEN days_before_departure <= 7 THEN '🟠 Booking within a week. Consider booking earlier for better prices.'
         WHEN days_before_departure <= 14 THEN '🟡 Decent booking window. Prices are near average.'
         WHEN days_before_departure <= 30 THEN '🟢 Good booking time! Prices are competitive.'
         WHEN days_before_departure <= 60 THEN '🟢 Great! Early booking discount applied.'
         ELSE '🌟 Excellent! Maximum early bird discount (~15% off).' END AS insight""",
    insight=lambda: texts.booking_insight(_col("days_before_departure"), rules.round_to_tens(_col("price"))),
)
_fare_rule(
    "f27_price_trend", _LEAD,
    """CASE WHEN days_before_departure <= 7 THEN 'Prices will likely increase as departure approaches'
         WHEN days_before_departure <= 21 THEN 'Prices are relatively stable in this booking window'
         ELSE 'Book now to lock in lower prices before they rise' END AS trend""",
    trend=lambda: texts.price_trend(_col("days_before_departure")),
)
_fare_rule(
    "f28_savings_tip", ("class", "days_before_departure", "departure_time"),
    """nullif(concat_ws(' | ',
         CASE WHEN days_before_departure < 30 THEN '💡 Booking 30+ days in advance could save ₹'
           || CAST(500 + days_before_departure * 50 AS VARCHAR) END,
         CASE WHEN class = 'Business' AND days_before_departure > 45
           THEN '💡 Business class fares may drop 2-3 weeks before departure' END,
         CASE WHEN departure_time IN ('Evening', 'Morning')
           THEN '💡 Early morning or night flights are typically 10-15% cheaper' END), '') AS tip""",
    tip=lambda: texts.savings_tip(_col("class"), _col("days_before_departure"), _col("departure_time")),
)
_fare_rule(
    "f33_clean_label", ("departure_time", "class"),
    "replace(departure_time, '_', ' ') AS slot_text, replace(class, '_', ' ') AS class_text",
    slot_text=lambda: texts.clean_label(_col("departure_time")), class_text=lambda: texts.clean_label(_col("class")),
)


@query(
    "f16_price_composition",
    with_priced("SELECT fare_key, rule_price, composed_price FROM priced"),
)
def f16(spark, sf_dir):
    return fixtures.priced_fares(spark, sf_dir).select("fare_key", "rule_price", "composed_price")


@query(
    "f20_route_popularity",
    with_fares(f"""
SELECT fare_key, r.route, route_frequency,
       round(route_frequency * 1.0e0 / (SELECT max(route_frequency) FROM {_ROUTES_SQL} m), 6) AS route_popularity_score
FROM fares LEFT JOIN {_ROUTES_SQL} r ON r.route = source_city || '-' || destination_city"""),
)
def f20(spark, sf_dir):
    rows = inputs.routed_fares(spark, sf_dir, "fare_key")
    scored = popularity.add_popularity(rows, popularity.popularity_table(rows))
    return scored.select(
        "fare_key", "route", "route_frequency", F.round("route_popularity_score", 6).alias("route_popularity_score")
    )


@query(
    "f21_absolute_error",
    with_priced("""
SELECT fare_key, price, rule_price, abs(price - rule_price) AS error FROM priced"""),
)
def f21(spark, sf_dir):
    rows = fixtures.priced_fares(spark, sf_dir, "price")
    error = rules.absolute_error(F.col("price"), F.col("rule_price"))
    return rows.select("fare_key", "price", "rule_price", error.alias("error"))


@query(
    "f22_price_ratio",
    with_quotes(f"""
SELECT fare_key, flight, price, round(price / baseline_price, 6) AS price_ratio
FROM quotes JOIN {_BASELINE_SQL} b USING (flight)"""),
)
def f22(spark, sf_dir):
    rows = baseline.with_ratio(fixtures.quotes(spark, sf_dir, "fare_key"))
    return rows.select("fare_key", "flight", "price", F.round("price_ratio", 6).alias("price_ratio"))


@query(
    "f23_multiplier_clamp",
    with_quotes(f"""
SELECT fare_key, round(greatest(least(price / baseline_price, 1.5e0), 0.3e0), 6) AS multiplier
FROM quotes JOIN {_BASELINE_SQL} b USING (flight)"""),
)
def f23(spark, sf_dir):
    rows = baseline.with_ratio(fixtures.quotes(spark, sf_dir, "fare_key"))
    clamped = rules.clamp_multiplier(F.col("price_ratio"))
    return rows.select("fare_key", F.round(clamped, 6).alias("multiplier"))


@query(
    "f24_final_price",
    with_quotes(f"""
SELECT fare_key, CAST(trunc(10000 * round(greatest(least(price / baseline_price, 1.5e0), 0.3e0), 6)) AS INTEGER)
         AS final_price
FROM quotes JOIN {_BASELINE_SQL} b USING (flight)"""),
)
def f24(spark, sf_dir):
    rows = baseline.with_ratio(fixtures.quotes(spark, sf_dir, "fare_key"))
    # Rounded first: truncation would show differences in the last bit of the mean.
    multiplier = F.round(rules.clamp_multiplier(F.col("price_ratio")), 6)
    return rows.select("fare_key", rules.final_price(F.lit(10000), multiplier).alias("final_price"))


@query(
    "f29_confidence",
    with_priced("""
SELECT source_city || '-' || destination_city AS route,
       CASE WHEN 1 - sum((price - rule_price) * (price - rule_price))
                     / nullif(var_pop(price) * count(*), 0) > 0.9 THEN 'Very High (R² > 0.9)'
            WHEN 1 - sum((price - rule_price) * (price - rule_price))
                     / nullif(var_pop(price) * count(*), 0) > 0.8 THEN 'High (R² > 0.8)'
            ELSE 'Moderate' END AS confidence
FROM priced GROUP BY 1"""),
)
def f29(spark, sf_dir):
    """Confidence of the rule price on each route."""
    rows = fixtures.priced_fares(spark, sf_dir, "price")
    error = F.col("price") - F.col("rule_price")
    r2 = 1 - F.try_divide(F.sum(error * error), F.var_pop("price") * F.count("*"))
    route = rules.route_key(F.col("source_city"), F.col("destination_city")).alias("route")
    return rows.groupBy(route).agg(texts.confidence(r2).alias("confidence"))


@query(
    "f30_strict_date",
    with_requests("""
SELECT request_id, flight_date, CAST(try_strptime(nullif(flight_date, ''), '%Y-%m-%d') AS DATE) AS flight_day
FROM requests"""),
)
def f30(spark, sf_dir):
    rows = inputs.requests(spark, sf_dir)
    return rows.select("request_id", "flight_date", rules.parse_date(F.col("flight_date")).alias("flight_day"))


_F31 = (
    "request_id", "distance_km", "stops", "month", "day_of_week", "is_weekend", "is_holiday", "flight_date",
)


@query("f31_default_filling", with_filled(f"SELECT {', '.join(_F31)} FROM filled"))
def f31(spark, sf_dir):
    checked = validation.with_reasons(inputs.requests(spark, sf_dir), inputs.vocabularies(spark, sf_dir))
    filled = quoting.with_defaults(
        validation.accepted(checked), fixtures.fixture_distances(spark, sf_dir), AS_OF_DATE
    )
    return filled.select(*_F31)


@query(
    "f32_money_and_share",
    with_fares("""
SELECT airline, '₹' || format('{:,}', CAST(round_even(avg(price), 0) AS BIGINT)) AS mean_price_text,
       printf('%.1f%%', round(100.0e0 * count(*) / (SELECT count(*) FROM fares), 6)) AS share_text
FROM fares GROUP BY airline"""),
)
def f32(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "airline", "price")
    stats = rows.groupBy("airline").agg(F.avg("price").alias("mean"), F.count("*").alias("n"))
    total = stats.select(F.sum("n")).scalar()
    return stats.select(
        "airline",
        texts.money(F.col("mean")).alias("mean_price_text"),
        texts.share(F.col("n") / total).alias("share_text"),
    )


@query(
    "f34_response_struct",
    with_filled("""
SELECT request_id, source_city || ' → ' || destination_city AS route, airline, cabin_class AS class, departure_time,
       distance_km, stops, days_before_departure, flight_date, CAST(is_weekend AS BOOLEAN) AS is_weekend,
       CAST(is_holiday AS BOOLEAN) AS is_holiday
FROM filled"""),
)
def f34(spark, sf_dir):
    context = inputs.quote_context(spark, sf_dir, scored=False)
    rows, _ = quoting.prepared(inputs.requests(spark, sf_dir), context)
    return rows.select("request_id", quoting.flight_details().alias("details")).select("request_id", "details.*")
