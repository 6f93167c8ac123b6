"""Fares, quotes and requests as views over the star-schema test tables.

A view joins only the tables its requested columns need. The lookups are left
joins on unique keys: a row whose key is null or has no partner stays, with
nulls, so the rows are the same whichever columns are asked for. ``dangling``
counts such keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farekit.functions import rules
from farekit.operators import pricing
from farekit.plans import features
from farekit.session import stage
from farekit.sources import dims, schemas

# Labels of the fixture's codes.
_SLOT_OF_PRIORITY = dict(
    zip(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), dims.SLOT_NAMES, strict=True)
)
_CLASS_OF_FLAG = {"N": "Economy", "A": "Premium_Economy", "R": "Business"}
_STOPS_OF_STATUS = {"O": "zero", "F": "one", "P": "two_or_more"}
_CABIN_OF_EVENT = {"view": "Economy", "click": "Economy", "signup": "Premium_Economy", "purchase": "Business"}
FIXTURE_AIRLINES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
FIXTURE_AIRLINE_MULTIPLIERS = (0.95, 1.05, 0.90, 1.20, 0.88, 0.92)
UNKNOWN_AIRLINE = "UNKNOWN"
# Flight ids start beyond 32 bits.
FLIGHT_BASE = 10_000_000_000

# Which lookup each fares column needs besides lineitem.
_NEEDS_ORDERS = {"departure_time", "stops", "days_before_departure"}
_NEEDS_CUSTOMER = {"destination_city"}
_NEEDS_SUPPLIER = {"source_city"}
_NEEDS_PART = {"airline", "distance_km"}

FARE_COLUMNS = (
    "fare_key",
    "airline",
    "source_city",
    "destination_city",
    "departure_time",
    "class",
    "stops",
    "distance_km",
    "date",
    "days_before_departure",
    "price",
    "route_id",
    "flight_id",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _relabel(code, labels: dict):
    chain = F
    for key, label in labels.items():
        chain = chain.when(code == key, F.lit(label))
    return chain


def fares(spark: SparkSession, sf_dir: str, *columns: str, cabin: str | None = None) -> DataFrame:
    """One row per line item, with the given columns (all when none is named).

    ``cabin`` keeps one class. It is compared as its code, before the code is
    relabelled, so that the scan can skip what it doesn't need.
    """
    wanted = set(columns or FARE_COLUMNS)
    unknown = wanted - set(FARE_COLUMNS)
    if unknown:
        raise ValueError(f"not fares columns: {sorted(unknown)}")

    rows = table(spark, sf_dir, "lineitem")
    if cabin is not None:
        codes = [flag for flag, name in _CLASS_OF_FLAG.items() if name == cabin]
        rows = rows.where(F.col("l_returnflag").isin(*codes))
    if wanted & (_NEEDS_ORDERS | _NEEDS_CUSTOMER):
        # Join the smaller tables first: line items are then shuffled once for both.
        orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
        if wanted & _NEEDS_CUSTOMER:
            customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
            orders = orders.join(customers, "o_custkey", "left")
        rows = rows.join(orders, "l_orderkey", "left")
    if wanted & _NEEDS_SUPPLIER:
        suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        rows = rows.join(suppliers, "l_suppkey", "left")
    if wanted & _NEEDS_PART:
        parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
        rows = rows.join(parts, "l_partkey", "left")
    # Names come last, so that only short keys and codes go through the shuffles.
    nation = table(spark, sf_dir, "nation")
    if wanted & _NEEDS_CUSTOMER:
        home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("destination_city"))
        rows = rows.join(home, "c_nationkey", "left")
    if wanted & _NEEDS_SUPPLIER:
        origin = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("source_city"))
        rows = rows.join(origin, "s_nationkey", "left")

    ship, order = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    made = {
        "fare_key": lambda: F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "airline": lambda: F.col("p_type"),
        "source_city": lambda: F.col("source_city"),
        "destination_city": lambda: F.col("destination_city"),
        "departure_time": lambda: _relabel(F.col("o_orderpriority"), _SLOT_OF_PRIORITY),
        "class": lambda: _relabel(F.col("l_returnflag"), _CLASS_OF_FLAG),
        "stops": lambda: _relabel(F.col("o_orderstatus"), _STOPS_OF_STATUS),
        "distance_km": lambda: (F.lit(100) + F.col("p_size") * 40).cast("double"),
        "date": lambda: ship,
        "days_before_departure": lambda: F.pmod(F.datediff(ship, order), F.lit(91)),
        "price": lambda: F.col("l_extendedprice"),
        # One of the known routes, by supplier.
        "route_id": lambda: (F.pmod("l_suppkey", F.lit(len(dims.route_rows()))) + 1).cast("int"),
        "flight_id": lambda: F.lit(FLIGHT_BASE) + F.col("l_orderkey") * 10 + F.col("l_linenumber"),
    }
    order_of = columns or FARE_COLUMNS
    return rows.select(*[made[name]().alias(name) for name in order_of])


def dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lookup, null_keys, missing_keys, used): line items by what their lookups find, one row per lookup.

    A lookup behind another counts only rows that the one before has found.
    One pass over the line items; the lookups carry a mark each.
    """
    key = lambda name: F.col(name)
    marked = lambda name, column, *extra: table(spark, sf_dir, name).select(
        F.col(column).alias(f"{name}_key"), *extra, F.lit(True).alias(f"{name}_found")
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    rows = rows.join(marked("orders", "o_orderkey", "o_custkey"), key("l_orderkey") == key("orders_key"), "left")
    rows = rows.join(marked("customer", "c_custkey", "c_nationkey"), key("o_custkey") == key("customer_key"), "left")
    rows = rows.join(marked("supplier", "s_suppkey", "s_nationkey"), key("l_suppkey") == key("supplier_key"), "left")
    rows = rows.join(marked("part", "p_partkey"), key("l_partkey") == key("part_key"), "left")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.lit(True).alias("found"))
    for role, column in (("home", "c_nationkey"), ("origin", "s_nationkey")):
        names = nation.select(F.col("n_nationkey").alias(f"{role}_key"), F.col("found").alias(f"{role}_found"))
        rows = rows.join(names, key(column) == key(f"{role}_key"), "left")
    reached = {
        "orders": ("l_orderkey", None), "customer": ("o_custkey", "orders"), "home": ("c_nationkey", "customer"),
        "supplier": ("l_suppkey", None), "origin": ("s_nationkey", "supplier"), "part": ("l_partkey", None),
    }
    counts = []
    for name, (column, before) in reached.items():
        there = F.lit(True) if before is None else F.col(f"{before}_found").isNotNull()
        found = F.col(f"{name}_found").isNotNull()
        counts.append(
            F.struct(
                F.lit(name).alias("lookup"),
                F.count_if(there & F.col(column).isNull()).alias("null_keys"),
                F.count_if(there & F.col(column).isNotNull() & ~found).alias("missing_keys"),
                F.count_if(found).alias("used"),
            ).alias(name)
        )
    one = rows.agg(*counts)
    return one.select(F.inline(F.array(*[F.col(name) for name in reached])))


def quotes(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Fares as price quotes: flight, days_left, classx, price."""
    base = fares(
        spark, sf_dir, "source_city", "destination_city", "days_before_departure", "class", "price", *extra
    )
    return base.select(
        *extra,
        rules.route_key(F.col("source_city"), F.col("destination_city")).alias("flight"),
        F.col("days_before_departure").alias("days_left"),
        F.col("class").alias("classx"),
        "price",
    )


def requests(events: DataFrame) -> DataFrame:
    """One quote request per event, batch or stream; every rule is broken by some and every field left out by some."""
    names = F.array(*[F.lit(name) for name in (*FIXTURE_AIRLINES, UNKNOWN_AIRLINE)])
    hour, event = F.hour("ts"), F.col("event_id")
    slot = F.when(event % 29 == 3, F.lit("Noon"))
    for i, name in enumerate(dims.SLOT_NAMES):
        slot = slot.when(hour.between(4 + 4 * i, 7 + 4 * i), F.lit(name))
    cabin = _relabel(F.col("event_type"), _CABIN_OF_EVENT).otherwise(F.col("event_type"))
    bad_date = F.when(event % 50 == 0, "2025-13-01").when(event % 50 == 1, "")
    stops = F.get(F.array(*[F.lit(s) for s in (*dims.STOPS, "three")]), (event % 8).cast("int"))
    # Flags 0 and 1, sometimes 2, mostly left out.
    flag = lambda modulus: F.when(event % modulus <= 2, (event % modulus).cast("int"))
    return events.select(
        event.alias("request_id"),
        F.when(event % 41 != 7, F.element_at(names, (F.col("user_id") % 7 + 1).cast("int"))).alias("airline"),
        F.when(event % 43 != 5, F.concat(F.lit("NATION_"), F.col("user_id") % 27)).alias("source_city"),
        F.when(event % 47 != 9, F.concat(F.lit("NATION_"), event % 27)).alias("destination_city"),
        slot.alias("departure_time"),
        F.when(event % 37 != 11, cabin).alias("cabin_class"),
        F.when(event % 31 != 4, F.get_json_object("props", "$.k").try_cast("int")).alias("days_before_departure"),
        bad_date.otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("flight_date"),
        F.when(event % 3 != 0, F.col("value") * 10).alias("distance_km"),
        stops.alias("stops"),
        flag(11).alias("is_weekend"),
        flag(13).alias("is_holiday"),
    )


def fixture_airlines(spark: SparkSession) -> DataFrame:
    pairs = tuple(zip(FIXTURE_AIRLINES, FIXTURE_AIRLINE_MULTIPLIERS, strict=True))
    return dims.values_table(spark, pairs, ("airline", "airline_multiplier"))


def fixture_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation with the attributes of the city at its position in name order.

    ``nation`` has 25 rows at every scale, so ranking it in one task is safe.
    """
    names = [name for name, *_ in dims.CITIES]
    city_at = F.element_at(F.array(*[F.lit(name) for name in names]), F.col("position") + 1)
    ranked = table(spark, sf_dir, "nation").selectExpr(
        "n_name AS city",
        "n_regionkey AS region",
        f"(row_number() OVER (ORDER BY n_name) - 1) % {len(names)} AS position",
    )
    known = dims.cities(spark).withColumnRenamed("city", "city_name")
    return ranked.withColumn("city_name", city_at).join(known, "city_name").drop("position")


def fixture_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known distances between nations, by the cities they stand for."""
    names = fixture_cities(spark, sf_dir).select("city", "city_name")
    first = names.select(F.col("city").alias("nation_a"), F.col("city_name").alias("city_a"))
    second = names.select(F.col("city").alias("nation_b"), F.col("city_name").alias("city_b"))
    pairs = (
        dims.distances(spark)
        .join(first, "city_a")
        .join(second, "city_b")
        .select(
            F.least("nation_a", "nation_b").alias("city_a"),
            F.greatest("nation_a", "nation_b").alias("city_b"),
            "known_km",
        )
    )
    # Staged, because the optimizer overestimates the size of joins of small tables.
    return stage(pairs, "distances")


def priced_fares(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Fares with every factor, the factor product ``rule_price`` and ``composed_price``."""
    base = fares(
        spark,
        sf_dir,
        *dict.fromkeys(
            (
                "fare_key",
                "airline",
                "source_city",
                "destination_city",
                "departure_time",
                "class",
                "distance_km",
                "date",
                "days_before_departure",
                *extra,
            )
        ),
    )
    factors = pricing.add_factors(
        base,
        airlines=fixture_airlines(spark),
        cities=fixture_cities(spark, sf_dir).select("city", "region", "code", "demand", "tier"),
        slots=dims.slots(spark),
        classes=dims.classes(spark),
        calendar=dims.yearly_calendar(spark),
    )
    same_region = F.col("source_region") == F.col("destination_region")
    factors = factors.withColumn("route_multiplier", F.when(same_region, 1.0).otherwise(0.95))
    return pricing.add_rule_price(factors)


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares as a flights table with all its 24 columns."""
    rows = features.calendar_columns(priced_fares(spark, sf_dir, "stops", "flight_id"))
    number = F.lit(100) + F.pmod("flight_id", F.lit(9900))
    # A flight lands in the slot after the one it leaves in.
    slots = F.array(*[F.lit(name) for name in dims.SLOT_NAMES])
    landing = F.get(slots, (F.array_position(slots, F.col("departure_time")) % len(dims.SLOT_NAMES)).cast("int"))
    made = {
        "flight_number": F.concat(rules.carrier_prefix(F.col("airline")), number.cast("string")),
        "arrival_time": landing,
        "duration": F.round(rules.nominal_duration(F.col("distance_km")), 2),
        "price": F.col("composed_price"),
        "booking_class": rules.booking_class(F.col("days_before_departure")),
        "route": rules.route_label(F.col("source_city"), F.col("destination_city")),
    }
    names = T.StructType.fromDDL(schemas.FLIGHTS).names
    return rows.select(*[made[name].alias(name) if name in made else F.col(name) for name in names])
