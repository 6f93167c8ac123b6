"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.catalog.registry import query
from farekit.catalog.views import with_checked, with_fares, with_quotes, with_requests
from farekit.operators import lookup, profile, validation
from farekit.plans import features
from farekit.session import scratch_path, stage
from farekit.sources import fixtures, readers, sinks

# Season months and urgency bands of the oracle.
_SEASON_SQL = """CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Summer'
            WHEN month(date) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Post_Monsoon' END"""
_URGENCY_SQL = """CASE WHEN days_before_departure <= 3 THEN 5.0e0 WHEN days_before_departure <= 7 THEN 3.5e0
            WHEN days_before_departure <= 14 THEN 2.0e0 WHEN days_before_departure <= 30 THEN 1.0e0
            WHEN days_before_departure <= 60 THEN 0.5e0 ELSE 0.2e0 END"""


@query("p01_project", with_fares("SELECT airline, source_city, destination_city, class, days_before_departure, price FROM fares"))
def p01(spark, sf_dir):
    return fixtures.fares(
        spark, sf_dir, "airline", "source_city", "destination_city", "class", "days_before_departure", "price"
    )


@query(
    "p02_derive",
    with_fares(f"""
SELECT fare_key, distance_km, distance_km * distance_km AS distance_squared, distance_km / 750.0e0 AS duration,
       CAST(CASE stops WHEN 'zero' THEN 0 WHEN 'one' THEN 1 ELSE 2 END AS INTEGER) AS stop_count,
       {_URGENCY_SQL} AS booking_urgency_score,
       CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
       {_SEASON_SQL} AS season,
       dayname(date) AS day_of_week,
       CAST(CASE WHEN departure_time IN ('Morning', 'Evening') THEN 1 ELSE 0 END AS INTEGER) AS is_peak_time,
       source_city || '-' || destination_city AS route
FROM fares"""),
)
def p02(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir).withColumns(
        {"duration": F.col("distance_km") / 750.0, "is_holiday": F.lit(0)}
    )
    return features.engineered_columns(features.calendar_columns(rows)).select(
        "fare_key", "distance_km", "distance_squared", "duration", "stop_count", "booking_urgency_score",
        "is_weekend", "month", "quarter", "season", "day_of_week", "is_peak_time", "route",
    )


@query(
    "p03_cast",
    """
SELECT event_id AS request_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS days_double,
       CAST(trunc(value) AS INTEGER) AS value_int, TRY_CAST(event_type AS INTEGER) AS type_int
FROM events""",
)
def p03(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.get_json_object("props", "$.k").try_cast("double").alias("days_double"),
        F.col("value").cast("int").alias("value_int"),
        F.col("event_type").try_cast("int").alias("type_int"),
    )


@query(
    "p04_rename",
    with_fares("SELECT source_city || '-' || destination_city AS route, count(*) AS route_frequency FROM fares GROUP BY 1"),
)
def p04(spark, sf_dir):
    return inputs.routed_fares(spark, sf_dir).groupBy("route").count().withColumnRenamed("count", "route_frequency")


@query("p05_equality_filter", with_quotes("SELECT * FROM quotes WHERE days_left = 1"))
def p05(spark, sf_dir):
    return fixtures.quotes(spark, sf_dir, "fare_key").where(F.col("days_left") == 1)


@query(
    "p06_disjunction",
    with_fares("SELECT fare_key, departure_time FROM fares WHERE departure_time = 'Morning' OR departure_time = 'Evening'"),
)
def p06(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key", "departure_time")
    return rows.where(F.col("departure_time").isin("Morning", "Evening"))


@query(
    "p07_membership",
    with_checked("""
SELECT request_id, airline, coalesce(airline IN (SELECT airline FROM known_airlines), false) AS airline_known,
       coalesce(cabin_class IN ('Economy', 'Premium_Economy', 'Business'), false) AS class_known
FROM requests"""),
)
def p07(spark, sf_dir):
    rows = inputs.requests(spark, sf_dir)
    names = inputs.vocabularies(spark, sf_dir)
    marked = lookup.mark_known(rows, names.airlines, "airline", "airline_known")
    allowed = F.col("cabin_class").isin(*validation.LISTS["cabin_class"])
    return marked.select(
        "request_id", "airline", "airline_known", F.coalesce(allowed, F.lit(False)).alias("class_known")
    )


@query(
    "p08_subset",
    with_fares("SELECT fare_key, class, date, price FROM fares WHERE class = 'Business' AND date >= DATE '2000-01-01'"),
)
def p08(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key", "class", "date", "price", cabin="Business")
    return rows.where(F.col("date") >= F.lit("2000-01-01").cast("date"))


_P8_COLUMNS = ("fare_key", "class", "date", "price")


@query(
    "p08_partitioned_copy",
    with_fares(f"SELECT {', '.join(_P8_COLUMNS)} FROM fares WHERE date BETWEEN DATE '1997-02-10' AND DATE '1998-06-20'"),
)
def p08_partitioned(spark, sf_dir):
    """A range of dates out of a copy that has a folder per month."""
    path = scratch_path(spark, "fares-by-month")
    sinks.write_by_month(fixtures.fares(spark, sf_dir, *_P8_COLUMNS), path)
    return readers.read_by_month(spark, path, "1997-02-10", "1998-06-20")


_P9_COLUMNS = ["departure_time", "distance_km", "days_before_departure"]
_P9_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _P9_COLUMNS)


@query(
    "p09_drop_incomplete",
    with_requests(f"SELECT request_id, {', '.join(_P9_COLUMNS)} FROM requests WHERE {_P9_COMPLETE}"),
)
def p09(spark, sf_dir):
    kept, _ = profile.without_incomplete(inputs.requests(spark, sf_dir), _P9_COLUMNS)
    return kept.select("request_id", *_P9_COLUMNS)


@query(
    "p09_dropped_report",
    with_requests(f"""
SELECT count(*) FILTER (WHERE {_P9_COMPLETE}) AS kept_rows,
       count(*) FILTER (WHERE NOT ({_P9_COMPLETE})) AS dropped_rows FROM requests"""),
)
def p09_report(spark, sf_dir):
    """Counted while the kept rows are written."""
    kept, dropped = profile.without_incomplete(inputs.requests(spark, sf_dir), _P9_COLUMNS)
    stage(kept, "complete")
    return dropped.report()


_LOOKUPS = (
    ("orders", "l_orderkey", "true", "o_orderkey"), ("customer", "o_custkey", "o_orderkey IS NOT NULL", "c_custkey"),
    ("home", "c_nationkey", "c_custkey IS NOT NULL", "dn.n_nationkey"), ("supplier", "l_suppkey", "true", "s_suppkey"),
    ("origin", "s_nationkey", "s_suppkey IS NOT NULL", "sn.n_nationkey"), ("part", "l_partkey", "true", "p_partkey"),
)


@query(
    "p09_dangling_keys",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS lookup, count(*) FILTER (WHERE {there} AND {column} IS NULL) AS null_keys,
       count(*) FILTER (WHERE {there} AND {column} IS NOT NULL AND {found} IS NULL) AS missing_keys,
       count(*) FILTER (WHERE {found} IS NOT NULL) AS used
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey LEFT JOIN nation dn ON dn.n_nationkey = c_nationkey"""
        for name, column, there, found in _LOOKUPS
    ),
)
def p09_dangling(spark, sf_dir):
    """Line items whose lookups have no key, or find nothing; the fares keep them, with nulls."""
    return fixtures.dangling(spark, sf_dir)


@query(
    "ud1_valid_names",
    with_checked("""
SELECT request_id, airline IS NOT NULL AND NOT unknown_airline AS is_valid_airline,
       source_city IS NOT NULL AND NOT unknown_source_city AS is_valid_source,
       destination_city IS NOT NULL AND NOT unknown_destination_city AS is_valid_destination FROM flagged"""),
)
def ud1(spark, sf_dir):
    marked = validation.mark_names(inputs.requests(spark, sf_dir), inputs.vocabularies(spark, sf_dir))
    return marked.select(
        "request_id",
        F.col("airline_known").alias("is_valid_airline"),
        F.col("source_known").alias("is_valid_source"),
        F.col("destination_known").alias("is_valid_destination"),
    )
