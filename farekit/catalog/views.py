"""The fixture views restated in ANSI SQL, for the oracle."""

from __future__ import annotations

from farekit.catalog.inputs import AS_OF_DATE
from farekit.sources import dims
from farekit.sources.fixtures import FIXTURE_AIRLINE_MULTIPLIERS, FIXTURE_AIRLINES, FLIGHT_BASE

_SLOTS = dims.values_sql(dims.SLOTS, ("slot", "slot_multiplier"), "slots")
_CLASSES = dims.values_sql(dims.CLASSES, ("cabin", "class_multiplier", "cap_low", "cap_high"), "cabins")
_AIRLINES = dims.values_sql(
    tuple(zip(FIXTURE_AIRLINES, FIXTURE_AIRLINE_MULTIPLIERS, strict=True)), ("carrier", "airline_multiplier"), "carriers"
)
_HOLIDAYS = dims.values_sql(dims.HOLIDAYS, ("holiday_date", "holiday", "boost"), "holidays")
_CITIES = dims.values_sql(
    tuple((i, *row) for i, row in enumerate(dims.CITIES)), ("position", "city_name", "code", "demand", "tier"), "cities"
)
ROUTES = dims.values_sql(dims.route_rows(), dims.ROUTE_COLUMNS, "route_table")
_DISTANCES = dims.values_sql(dims.DISTANCES, ("x", "y", "km"), "km_table")

FARES = f"""fares AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS fare_key,
         p_type AS airline, sn.n_name AS source_city, dn.n_name AS destination_city,
         sn.n_regionkey AS source_region, dn.n_regionkey AS destination_region,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Early_Morning' WHEN '2-HIGH' THEN 'Morning'
              WHEN '3-MEDIUM' THEN 'Afternoon' WHEN '4-NOT SPECIFIED' THEN 'Evening'
              WHEN '5-LOW' THEN 'Night' END AS departure_time,
         CASE l_returnflag WHEN 'N' THEN 'Economy' WHEN 'A' THEN 'Premium_Economy' WHEN 'R' THEN 'Business' END AS class,
         CASE o_orderstatus WHEN 'O' THEN 'zero' WHEN 'F' THEN 'one' WHEN 'P' THEN 'two_or_more' END AS stops,
         CAST(100 + 40 * p_size AS DOUBLE) AS distance_km,
         CAST(l_shipdate AS DATE) AS date,
         CAST(((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 91) + 91) % 91 AS INTEGER)
           AS days_before_departure,
         l_extendedprice AS price, CAST(l_suppkey % {len(dims.route_rows())} + 1 AS INTEGER) AS route_id,
         {FLIGHT_BASE} + l_orderkey * 10 + l_linenumber AS flight_id
  FROM lineitem
  LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
  LEFT JOIN nation dn ON dn.n_nationkey = c_nationkey
)"""

QUOTES = """quotes AS (
  SELECT fare_key, source_city || '-' || destination_city AS flight, days_before_departure AS days_left,
         class AS classx, price
  FROM fares
)"""

CITIES = f"""city_dim AS (
  SELECT n.n_name AS city, cities.city_name, cities.code, cities.demand, cities.tier
  FROM (SELECT n_name, (row_number() OVER (ORDER BY n_name) - 1) % 20 AS position FROM nation) n
  JOIN {_CITIES} ON cities.position = n.position
)"""

HOLIDAYS = f"""holiday_dim AS (
  SELECT CAST(month(CAST(holiday_date AS DATE)) AS INTEGER) AS hm, CAST(day(CAST(holiday_date AS DATE)) AS INTEGER) AS hd,
         holiday, boost
  FROM {_HOLIDAYS}
)"""

DISTANCES = f"""distance_dim AS (
  SELECT least(a.city, b.city) AS ka, greatest(a.city, b.city) AS kb, CAST(km AS DOUBLE) AS km
  FROM {_DISTANCES} JOIN city_dim a ON a.city_name = x JOIN city_dim b ON b.city_name = y
)"""

FACTORS = f"""factors AS (
  SELECT f.*, airline_multiplier, slot_multiplier, class_multiplier,
         CASE WHEN source_region = destination_region THEN 1.0e0 ELSE 0.95e0 END AS route_multiplier,
         CASE WHEN month(date) IN (12, 1) THEN 1.25e0 WHEN month(date) IN (4, 5, 6) THEN 1.2e0
              WHEN month(date) IN (10, 11) THEN 1.3e0 WHEN month(date) IN (2, 3, 9) THEN 1.05e0
              ELSE 0.85e0 END AS seasonal_factor,
         CASE isodow(date) WHEN 5 THEN 1.2e0 WHEN 6 THEN 1.25e0 WHEN 7 THEN 1.25e0 WHEN 1 THEN 1.1e0
              ELSE 1.0e0 END AS weekday_factor,
         CASE WHEN days_before_departure <= 3 THEN 1.5e0 WHEN days_before_departure <= 7 THEN 1.3e0
              WHEN days_before_departure <= 14 THEN 1.15e0 WHEN days_before_departure <= 30 THEN 1.0e0
              WHEN days_before_departure <= 60 THEN 0.9e0 ELSE 0.85e0 END AS advance_factor,
         h.holiday, coalesce(h.boost, 1.0e0) AS holiday_boost,
         CASE WHEN h.holiday IS NULL THEN 0 ELSE 1 END AS is_holiday,
         s.code AS source_code, s.demand AS source_demand, s.tier AS source_tier,
         d.code AS destination_code, d.demand AS destination_demand, d.tier AS destination_tier,
         cap_low, cap_high
  FROM fares f
  LEFT JOIN {_AIRLINES} ON carrier = airline
  LEFT JOIN {_SLOTS} ON slot = departure_time
  LEFT JOIN {_CLASSES} ON cabin = class
  LEFT JOIN city_dim s ON s.city = source_city
  LEFT JOIN city_dim d ON d.city = destination_city
  LEFT JOIN holiday_dim h ON hm = month(date) AND hd = day(date)
)"""

PRICED = """ruled AS (
  SELECT *, distance_km * 3.5e0 * airline_multiplier * route_multiplier * slot_multiplier * class_multiplier
            * seasonal_factor * weekday_factor * advance_factor * holiday_boost * source_demand * destination_demand
            AS rule_price,
         CAST(('0x' || substr(md5(fare_key), 1, 8)) AS BIGINT) AS key_hash
  FROM factors
), priced AS (
  SELECT *, CASE WHEN rule_price IS NOT NULL THEN CAST(greatest(least(CAST(trunc(rule_price) AS INTEGER),
                                coalesce(cap_high, 60000)), coalesce(cap_low, 8000)) AS INTEGER) END AS composed_price
  FROM ruled
)"""

# The flights table with all its columns.
FLIGHTS = """flights AS (
  SELECT flight_id, date, airline, upper(substr(airline, 1, 2)) || CAST(100 + flight_id % 9900 AS VARCHAR) AS flight_number,
         source_city, source_code, destination_city, destination_code, departure_time,
         CASE departure_time WHEN 'Early_Morning' THEN 'Morning' WHEN 'Morning' THEN 'Afternoon' WHEN 'Afternoon' THEN 'Evening'
              WHEN 'Evening' THEN 'Night' WHEN 'Night' THEN 'Early_Morning' END AS arrival_time,
         round(distance_km / 750.0e0, 2) AS duration, stops, class, distance_km, composed_price AS price,
         days_before_departure, dayname(date) AS day_of_week,
         CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, is_holiday,
         CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
         CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Summer'
              WHEN month(date) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Post_Monsoon' END AS season,
         CASE WHEN days_before_departure <= 7 THEN 'Last_Minute' WHEN days_before_departure >= 30 THEN 'Advance'
              ELSE 'Normal' END AS booking_class,
         source_city || ' → ' || destination_city AS route
  FROM priced
)"""

REQUESTS = """requests AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 41 <> 7 THEN
           CASE user_id % 7 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO'
                WHEN 4 THEN 'SMALL' WHEN 5 THEN 'STANDARD' ELSE 'UNKNOWN' END END AS airline,
         CASE WHEN event_id % 43 <> 5 THEN 'NATION_' || CAST(user_id % 27 AS VARCHAR) END AS source_city,
         CASE WHEN event_id % 47 <> 9 THEN 'NATION_' || CAST(event_id % 27 AS VARCHAR) END AS destination_city,
         CASE WHEN event_id % 29 = 3 THEN 'Noon'
              WHEN hour(ts) BETWEEN 4 AND 7 THEN 'Early_Morning' WHEN hour(ts) BETWEEN 8 AND 11 THEN 'Morning'
              WHEN hour(ts) BETWEEN 12 AND 15 THEN 'Afternoon' WHEN hour(ts) BETWEEN 16 AND 19 THEN 'Evening'
              WHEN hour(ts) BETWEEN 20 AND 23 THEN 'Night' END AS departure_time,
         CASE WHEN event_id % 37 <> 11 THEN
           CASE event_type WHEN 'view' THEN 'Economy' WHEN 'click' THEN 'Economy' WHEN 'signup' THEN 'Premium_Economy'
                WHEN 'purchase' THEN 'Business' ELSE event_type END END AS cabin_class,
         CASE WHEN event_id % 31 <> 4 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS days_before_departure,
         CASE event_id % 50 WHEN 0 THEN '2025-13-01' WHEN 1 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS flight_date,
         CASE WHEN event_id % 3 <> 0 THEN value * 10 END AS distance_km,
         CASE event_id % 8 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two_or_more' WHEN 3 THEN 'three' END AS stops,
         CAST(CASE WHEN event_id % 11 <= 2 THEN event_id % 11 END AS INTEGER) AS is_weekend,
         CAST(CASE WHEN event_id % 13 <= 2 THEN event_id % 13 END AS INTEGER) AS is_holiday
  FROM events
)"""

# The six-field form: three fields default, five are left open.
QUICK_REQUESTS = REQUESTS.replace("requests AS", "asked AS") + """, requests AS (
  SELECT request_id, airline, source_city, destination_city, coalesce(departure_time, 'Morning') AS departure_time,
         coalesce(cabin_class, 'Economy') AS cabin_class, coalesce(days_before_departure, 30) AS days_before_departure,
         CAST(NULL AS VARCHAR) AS flight_date, CAST(NULL AS DOUBLE) AS distance_km,
         CAST(NULL AS VARCHAR) AS stops, CAST(NULL AS INTEGER) AS is_weekend, CAST(NULL AS INTEGER) AS is_holiday
  FROM asked
)"""

# One boolean per rule; a null value breaks only the required-field rule.
CHECKED = """known_airlines AS (SELECT DISTINCT airline FROM fares),
known_cities AS (SELECT source_city AS city FROM fares UNION SELECT destination_city FROM fares),
flagged AS (
  SELECT *,
         airline IS NOT NULL AND airline NOT IN (SELECT airline FROM known_airlines) AS unknown_airline,
         source_city IS NOT NULL AND source_city NOT IN (SELECT city FROM known_cities) AS unknown_source_city,
         destination_city IS NOT NULL AND destination_city NOT IN (SELECT city FROM known_cities)
           AS unknown_destination_city,
         coalesce(source_city = destination_city, false) AS same_city,
         coalesce(days_before_departure NOT BETWEEN 0 AND 90, false) AS days_before_departure_out_of_range,
         coalesce(distance_km NOT BETWEEN 100 AND 3000, false) AS distance_km_out_of_range,
         coalesce(is_weekend NOT BETWEEN 0 AND 1, false) AS is_weekend_out_of_range,
         coalesce(is_holiday NOT BETWEEN 0 AND 1, false) AS is_holiday_out_of_range,
         coalesce(departure_time NOT IN ('Early_Morning', 'Morning', 'Afternoon', 'Evening', 'Night'), false)
           AS bad_departure_time,
         coalesce(cabin_class NOT IN ('Economy', 'Premium_Economy', 'Business'), false) AS bad_cabin_class,
         coalesce(stops NOT IN ('zero', 'one', 'two_or_more'), false) AS bad_stops,
         airline IS NULL AS missing_airline, source_city IS NULL AS missing_source_city,
         destination_city IS NULL AS missing_destination_city, departure_time IS NULL AS missing_departure_time,
         cabin_class IS NULL AS missing_cabin_class, days_before_departure IS NULL AS missing_days_before_departure,
         nullif(flight_date, '') IS NOT NULL AND try_strptime(nullif(flight_date, ''), '%Y-%m-%d') IS NULL
           AS bad_flight_date
  FROM requests
),
checked AS (
  SELECT *, concat_ws(',',
           CASE WHEN bad_cabin_class THEN 'bad_cabin_class' END,
           CASE WHEN bad_departure_time THEN 'bad_departure_time' END,
           CASE WHEN bad_flight_date THEN 'bad_flight_date' END,
           CASE WHEN bad_stops THEN 'bad_stops' END,
           CASE WHEN days_before_departure_out_of_range THEN 'days_before_departure_out_of_range' END,
           CASE WHEN distance_km_out_of_range THEN 'distance_km_out_of_range' END,
           CASE WHEN is_holiday_out_of_range THEN 'is_holiday_out_of_range' END,
           CASE WHEN is_weekend_out_of_range THEN 'is_weekend_out_of_range' END,
           CASE WHEN missing_airline THEN 'missing_airline' END,
           CASE WHEN missing_cabin_class THEN 'missing_cabin_class' END,
           CASE WHEN missing_days_before_departure THEN 'missing_days_before_departure' END,
           CASE WHEN missing_departure_time THEN 'missing_departure_time' END,
           CASE WHEN missing_destination_city THEN 'missing_destination_city' END,
           CASE WHEN missing_source_city THEN 'missing_source_city' END,
           CASE WHEN same_city THEN 'same_city' END,
           CASE WHEN unknown_airline THEN 'unknown_airline' END,
           CASE WHEN unknown_destination_city THEN 'unknown_destination_city' END,
           CASE WHEN unknown_source_city THEN 'unknown_source_city' END) AS reasons
  FROM flagged
)"""

FILLED = f"""dated AS (
  SELECT *, CAST(try_strptime(nullif(flight_date, ''), '%Y-%m-%d') AS DATE) AS flight_day
  FROM checked WHERE reasons = ''
), filled AS (
  SELECT request_id, airline, source_city, destination_city, departure_time, cabin_class, days_before_departure,
         coalesce(distance_km, km, 1000.0e0) AS distance_km, coalesce(stops, 'zero') AS stops,
         CAST(month(coalesce(flight_day, DATE '{AS_OF_DATE}')) AS INTEGER) AS month,
         coalesce(dayname(flight_day), 'Monday') AS day_of_week,
         CAST(coalesce(CASE WHEN isodow(flight_day) >= 6 THEN 1 WHEN isodow(flight_day) < 6 THEN 0 END, is_weekend, 0)
              AS INTEGER) AS is_weekend,
         CAST(coalesce(is_holiday, 0) AS INTEGER) AS is_holiday,
         coalesce(nullif(flight_date, ''), 'Not specified') AS flight_date
  FROM dated LEFT JOIN distance_dim
    ON ka = least(source_city, destination_city) AND kb = greatest(source_city, destination_city)
)"""


def _with(*parts: str):
    prefix = "WITH " + ",\n".join(parts) + "\n"
    return lambda select: prefix + select


with_fares = _with(FARES)
with_quotes = _with(FARES, QUOTES)
with_priced = _with(FARES, CITIES, HOLIDAYS, FACTORS, PRICED)
with_flights = _with(FARES, CITIES, HOLIDAYS, FACTORS, PRICED, FLIGHTS)
with_requests = _with(REQUESTS)
with_checked = _with(FARES, REQUESTS, CHECKED)
with_distances = _with(CITIES, DISTANCES, REQUESTS)
with_filled = _with(FARES, REQUESTS, CHECKED, CITIES, DISTANCES, FILLED)
with_quick = _with(FARES, QUICK_REQUESTS, CHECKED, CITIES, DISTANCES, FILLED)
