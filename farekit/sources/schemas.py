"""Declared schemas, as DDL. Declaring them saves the extra scan of type inference."""

from __future__ import annotations

FLIGHTS = (
    "flight_id bigint, date date, airline string, flight_number string, "
    "source_city string, source_code string, destination_city string, destination_code string, "
    "departure_time string, arrival_time string, duration double, stops string, class string, "
    "distance_km double, price int, days_before_departure int, day_of_week string, "
    "is_weekend int, is_holiday int, month int, quarter int, season string, booking_class string, "
    "route string"
)

QUOTES = "flight string, days_left int, classx string, price double"

REQUESTS = (
    "request_id bigint, airline string, source_city string, destination_city string, "
    "departure_time string, cabin_class string, days_before_departure int, flight_date string, "
    "distance_km double, stops string, is_weekend int, is_holiday int"
)

# Beside the requests read from JSON: the text of a record that is no request, null for any other.
UNREADABLE = "unreadable_text"

METADATA = (
    "valid_airlines array<string>, valid_cities array<string>, rmse double, mae double, r2 double, "
    "training_date string, total_flights_trained bigint"
)

# The star-schema test tables.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
