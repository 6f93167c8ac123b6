"""Aggregations, sorts, top-k and the set operation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.catalog import inputs
from farekit.catalog.joins import _BASELINE_SQL, _ROUTES_SQL
from farekit.catalog.registry import query
from farekit.catalog.views import with_fares, with_priced, with_quotes
from farekit.operators import baseline, encode, lookup, popularity, profile
from farekit.session import stage
from farekit.sources import fixtures


@query("a01_global_count", with_fares("SELECT count(*) AS n FROM fares"))
def a01(spark, sf_dir):
    return fixtures.fares(spark, sf_dir, "fare_key").agg(F.count("*").alias("n"))


def _stats_sql(keys: str) -> str:
    return with_quotes(f"""
SELECT {keys}, round(avg(price), 6) AS avg_price, min(price) AS min_price, max(price) AS max_price,
       count(price) AS count FROM quotes GROUP BY {keys}""")


def _price_stats(spark, sf_dir, keys):
    table = profile.stats_by(fixtures.quotes(spark, sf_dir), "price", keys)
    return table.withColumn("avg_price", F.round("avg_price", 6))


@query("a02_stats_by_lead_time", _stats_sql("days_left"))
def a02_lead(spark, sf_dir):
    return _price_stats(spark, sf_dir, ["days_left"])


@query("a02_stats_by_class", _stats_sql("classx"))
def a02_class(spark, sf_dir):
    return _price_stats(spark, sf_dir, ["classx"])


@query(
    "a03_stats_by_two_keys",
    with_quotes("""
SELECT flight, days_left, round(avg(price), 6) AS avg_price, count(price) AS count FROM quotes GROUP BY 1, 2"""),
)
def a03(spark, sf_dir):
    table = profile.stats_by(fixtures.quotes(spark, sf_dir), "price", ["flight", "days_left"], spread=False)
    return table.withColumn("avg_price", F.round("avg_price", 6))


_PRICE_SETS = {"lead_time": ["days_left"], "class": ["classx"], "flight": ["flight", "days_left"]}
_SET_SQL = " UNION ALL ".join(
    f"""SELECT '{part}' AS part, {", ".join(f"{k if k in keys else 'NULL'} AS {k}" for k in ("days_left", "classx", "flight"))},
       round(avg(price), 6) AS avg_price, min(price) AS min_price, max(price) AS max_price, count(price) AS count
FROM quotes GROUP BY {", ".join(keys)}"""
    for part, keys in _PRICE_SETS.items()
)


@query("a03_stats_in_one_pass", with_quotes(_SET_SQL))
def a03_sets(spark, sf_dir):
    """The three groupings of the price statistics from one aggregation."""
    table = profile.stats_by_sets(fixtures.quotes(spark, sf_dir), "price", _PRICE_SETS)
    return table.withColumn("avg_price", F.round("avg_price", 6))


@query(
    "a17_report_in_one_pass",
    with_fares("""
SELECT 'summary' AS part, NULL AS name, count(*) AS n, round(avg(price), 6) AS number FROM fares
UNION ALL SELECT 'routes', NULL, count(DISTINCT source_city || '-' || destination_city), NULL FROM fares
UNION ALL SELECT 'median', NULL, NULL, round(median(price), 6) FROM fares
UNION ALL SELECT 'airline', airline, count(*), round(count(*) * 1.0e0 / (SELECT count(*) FROM fares), 6) FROM fares GROUP BY airline
UNION ALL SELECT 'class', class, count(*), round(count(*) * 1.0e0 / (SELECT count(*) FROM fares), 6) FROM fares GROUP BY class
UNION ALL SELECT 'top_route', route, n, NULL FROM (
  SELECT source_city || '-' || destination_city AS route, count(*) AS n FROM fares GROUP BY 1 ORDER BY n DESC, route LIMIT 10)"""),
)
def a17_report(spark, sf_dir):
    """The parts of the report, all from one aggregation over the flights."""
    rows = inputs.routed_fares(spark, sf_dir, "airline", "class", "date", "price")
    found = profile.Report.of(rows, 365)
    part = lambda df, part, name, n, number: df.select(
        F.lit(part).alias("part"), F.lit(name).cast("string").alias("name") if name is None else F.col(name).alias("name"),
        (F.col(n) if n else F.lit(None)).cast("long").alias("n"),
        (F.round(number, 6) if number else F.lit(None)).cast("double").alias("number"),
    )
    parts = [
        part(found.part("all"), "summary", None, "n", "mean_price"),
        part(found.summary(), "routes", None, "total_routes", None),
        part(found.median_price(), "median", None, None, "median"),
        part(found.shares("airline"), "airline", "airline", "n", "share"),
        part(found.shares("class"), "class", "class", "n", "share"),
        part(found.top_routes(10), "top_route", "route", "n", None),
    ]
    return reduce(DataFrame.union, parts)


_RATIO_SQL = f"""(SELECT q.*, price / baseline_price AS price_ratio FROM quotes q JOIN {_BASELINE_SQL} b USING (flight))"""
_RATIO_STATS_SQL = f"""
SELECT days_left, classx, round(avg(price_ratio), 6) AS avg_price_ratio, round(min(price_ratio), 6) AS min_price_ratio,
       round(max(price_ratio), 6) AS max_price_ratio, count(price_ratio) AS count
FROM {_RATIO_SQL} r GROUP BY 1, 2"""


def _ratio_stats(spark, sf_dir):
    table = baseline.ratio_stats(baseline.with_ratio(fixtures.quotes(spark, sf_dir)))
    return table.withColumns({c: F.round(c, 6) for c in table.columns if c.endswith("price_ratio")})


@query("a04_ratio_stats", with_quotes(_RATIO_STATS_SQL))
def a04(spark, sf_dir):
    return _ratio_stats(spark, sf_dir)


@query("a05_baseline", with_quotes(f"SELECT flight, round(baseline_price, 6) AS baseline_price FROM {_BASELINE_SQL} b"))
def a05(spark, sf_dir):
    table = baseline.baseline_prices(fixtures.quotes(spark, sf_dir))
    return table.withColumn("baseline_price", F.round("baseline_price", 6))


@query(
    "a05_baseline_by_class",
    with_quotes("""
SELECT flight, classx, round(avg(price), 6) AS baseline_price FROM quotes WHERE days_left = 1 GROUP BY 1, 2"""),
)
def a05_class(spark, sf_dir):
    table = baseline.baseline_prices(fixtures.quotes(spark, sf_dir), by_class=True)
    return table.withColumn("baseline_price", F.round("baseline_price", 6))


@query("a06_group_size", with_fares(f"SELECT * FROM {_ROUTES_SQL} r"))
def a06(spark, sf_dir):
    return popularity.route_counts(inputs.routed_fares(spark, sf_dir))


@query("a07_global_max", with_fares(f"SELECT max(route_frequency) AS max_route_frequency FROM {_ROUTES_SQL} r"))
def a07(spark, sf_dir):
    counts = popularity.route_counts(inputs.routed_fares(spark, sf_dir))
    return counts.agg(F.max("route_frequency").alias("max_route_frequency"))


@query("a08_distinct_flights", with_quotes("SELECT DISTINCT flight FROM quotes"))
def a08_flights(spark, sf_dir):
    return fixtures.quotes(spark, sf_dir).select("flight").distinct()


@query("a08_distinct_airlines", with_fares("SELECT DISTINCT airline FROM fares"))
def a08_airlines(spark, sf_dir):
    return fixtures.fares(spark, sf_dir, "airline").distinct()


@query("a08_distinct_sources", with_fares("SELECT DISTINCT source_city FROM fares"))
def a08_sources(spark, sf_dir):
    return fixtures.fares(spark, sf_dir, "source_city").distinct()


@query("a08_distinct_destinations", with_fares("SELECT DISTINCT destination_city FROM fares"))
def a08_destinations(spark, sf_dir):
    return fixtures.fares(spark, sf_dir, "destination_city").distinct()


@query(
    "a09_count_distinct",
    with_fares("SELECT count(DISTINCT source_city || '-' || destination_city) AS total_routes FROM fares"),
)
def a09(spark, sf_dir):
    return inputs.routed_fares(spark, sf_dir).agg(F.count_distinct("route").alias("total_routes"))


@query(
    "a10_mean_min_max",
    with_fares("""
SELECT round(avg(price), 6) AS mean_price, min(price) AS min_price, max(price) AS max_price,
       min(date) AS first_date, max(date) AS last_date FROM fares"""),
)
def a10(spark, sf_dir):
    return fixtures.fares(spark, sf_dir, "price", "date").agg(
        F.round(F.avg("price"), 6).alias("mean_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


@query("a11_exact_median", with_fares("SELECT round(median(price), 6) AS median_price FROM fares"))
def a11(spark, sf_dir):
    table = profile.median(fixtures.fares(spark, sf_dir, "price"), "price")
    return table.select(F.round("median", 6).alias("median_price"))


_RANK_ERROR = 0.001


@query(
    "a11_approximate_median",
    with_fares("SELECT class, count(price) AS n, true AS is_a_price, true AS rank_within_error FROM fares GROUP BY class"),
)
def a11_approximate(spark, sf_dir):
    """By class: whether the approximate median is one of the prices and near the middle of their order."""
    rows = fixtures.fares(spark, sf_dir, "class", "price")
    middle = stage(profile.approximate_median(rows, "price", ["class"], _RANK_ERROR), "middles")
    ranked = rows.join(middle.withColumnRenamed("class", "of_class"), F.col("class").eqNullSafe(F.col("of_class")))
    counted = ranked.groupBy("class").agg(
        F.count("price").alias("n"), F.count_if(F.col("price") < F.col("median")).alias("below"),
        F.count_if(F.col("price") <= F.col("median")).alias("upto"),
    )
    off = F.greatest(F.col("below") - F.col("n") / 2, F.col("n") / 2 - F.col("upto"))
    return counted.select(
        "class", "n", (F.col("upto") > F.col("below")).alias("is_a_price"),
        (off <= F.col("n") * _RANK_ERROR + 1).alias("rank_within_error"),
    )


def _shares_sql(column: str) -> str:
    return with_fares(f"""
SELECT {column}, count(*) AS n, round(count(*) * 1.0e0 / (SELECT count(*) FROM fares), 6) AS share
FROM fares GROUP BY {column}""")


@query("a12_airline_shares", _shares_sql("airline"))
def a12_airline(spark, sf_dir):
    table = profile.value_shares(fixtures.fares(spark, sf_dir, "airline"), "airline")
    return table.withColumn("share", F.round("share", 6)).orderBy(F.desc("n"), "airline")


@query("a12_class_shares", _shares_sql("class"))
def a12_class(spark, sf_dir):
    table = profile.value_shares(fixtures.fares(spark, sf_dir, "class"), "class")
    return table.withColumn("share", F.round("share", 6)).orderBy(F.desc("n"), "class")


@query("a13_rows_per_day", with_fares("SELECT round(count(*) / 365.0e0, 6) AS flights_per_day FROM fares"))
def a13(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "fare_key")
    return rows.agg(F.round(profile.rows_per_day(rows, 365), 6).alias("flights_per_day"))


@query(
    "a14_conditional_means",
    with_fares("""
SELECT round(avg(price) FILTER (WHERE class = 'Economy'), 6) AS economy_mean,
       round(avg(price) FILTER (WHERE class = 'Business'), 6) AS business_mean FROM fares"""),
)
def a14(spark, sf_dir):
    mean_of = lambda name: F.round(F.avg(F.when(F.col("class") == name, F.col("price"))), 6)
    return fixtures.fares(spark, sf_dir, "class", "price").agg(
        mean_of("Economy").alias("economy_mean"), mean_of("Business").alias("business_mean")
    )


_METRICS_SQL = with_priced("""
SELECT round(sqrt(avg((price - rule_price) * (price - rule_price))), 6) AS rmse,
       round(avg(abs(price - rule_price)), 6) AS mae,
       round(1 - sum((price - rule_price) * (price - rule_price))
                 / (var_pop(price) * count(*)), 6) AS r2,
       round(avg(abs(price - rule_price)) / avg(price) * 100, 6) AS error_percent,
       count(*) AS n
FROM priced WHERE key_hash % 100 >= 80""")


def _rule_metrics(spark, sf_dir):
    _, held_out = encode.split(fixtures.priced_fares(spark, sf_dir, "price"), F.col("fare_key"))
    table = encode.regression_metrics(held_out, "price", "rule_price")
    return table.select(*[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2", "error_percent")], "n")


@query("m11_regression_metrics", _METRICS_SQL)
def m11(spark, sf_dir):
    return _rule_metrics(spark, sf_dir)


@query("a15_relative_error", _METRICS_SQL.replace("SELECT round(sqrt", "SELECT error_percent FROM (SELECT round(sqrt") + ") m")
def a15(spark, sf_dir):
    return _rule_metrics(spark, sf_dir).select("error_percent")


@query("a16_rows_by_date", with_fares("SELECT date, count(*) AS n FROM fares GROUP BY date"))
def a16(spark, sf_dir):
    return fixtures.fares(spark, sf_dir, "date").groupBy("date").agg(F.count("*").alias("n"))


@query("o01_sort_one_key", _stats_sql("days_left") + " ORDER BY days_left")
def o01(spark, sf_dir):
    return _price_stats(spark, sf_dir, ["days_left"]).orderBy("days_left")


@query("o02_sort_two_keys", with_quotes(_RATIO_STATS_SQL + " ORDER BY days_left, classx"))
def o02(spark, sf_dir):
    return _ratio_stats(spark, sf_dir).orderBy("days_left", "classx")


@query(
    "o03_limit",
    with_quotes("SELECT * FROM quotes ORDER BY price DESC, fare_key, flight, days_left, classx LIMIT 10"),
)
def o03(spark, sf_dir):
    rows = fixtures.quotes(spark, sf_dir, "fare_key")
    return rows.orderBy(F.desc("price"), "fare_key", "flight", "days_left", "classx").limit(10)


@query(
    "o04_top_routes",
    with_fares("""
SELECT source_city || '-' || destination_city AS route, count(*) AS n FROM fares
GROUP BY 1 ORDER BY n DESC, route LIMIT 10"""),
)
def o04(spark, sf_dir):
    return profile.top_values(inputs.routed_fares(spark, sf_dir), "route", 10)


_CITY_UNION_SQL = with_fares("SELECT source_city AS city FROM fares UNION SELECT destination_city FROM fares")


@query("o06_sorted_vocabulary", _CITY_UNION_SQL + " ORDER BY city")
def o06(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "source_city", "destination_city")
    return lookup.distinct_values(rows, "source_city", "destination_city", name="city").orderBy("city")


@query("u01_union_distinct", _CITY_UNION_SQL)
def u01(spark, sf_dir):
    rows = fixtures.fares(spark, sf_dir, "source_city", "destination_city")
    return lookup.distinct_values(rows, "source_city", "destination_city", name="city")
