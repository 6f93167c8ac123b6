"""Descriptive aggregates: grouped statistics, shares, medians, top-k, summary."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farekit.functions import rules, texts
from farekit.session import stage


def stats_by(df: DataFrame, value: str, keys: list[str], *, spread: bool = True) -> DataFrame:
    """avg, count and, with ``spread``, min and max of a value by keys."""
    measures = [F.avg(value).alias(f"avg_{value}")]
    if spread:
        measures += [F.min(value).alias(f"min_{value}"), F.max(value).alias(f"max_{value}")]
    return df.groupBy(*keys).agg(*measures, F.count(value).alias("count"))


def by_sets(df: DataFrame, sets: dict[str, list[str]], *measures: Column) -> DataFrame:
    """Measures by several sets of keys from one aggregation: ``part`` names the set, keys outside of it are null.

    An empty list of keys gives one row for the whole table, if it has rows. A key that is null
    in the rows is a group of its own in every set that has it; ``part`` tells
    it from a key that the set doesn't have.
    """
    keys = list(dict.fromkeys(key for names in sets.values() for key in names))
    if len({frozenset(names) for names in sets.values()}) < len(sets):
        raise ValueError("two sets have the same keys")
    # The first key is the highest bit of the grouping id; a bit is set if the key is left out.
    number = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in names) for name, names in sets.items()}
    if not keys:
        return df.agg(*measures).select(F.lit(next(iter(sets))).alias("part"), "*")
    grouped = df.groupingSets([[F.col(k) for k in names] for names in sets.values()], *[F.col(k) for k in keys])
    part = F
    for name, bits in number.items():
        part = part.when(F.col("__set") == bits, F.lit(name))
    found = grouped.agg(F.grouping_id().alias("__set"), *measures)
    return found.withColumn("part", part).select("part", *[c for c in found.columns if c != "__set"])


def stats_by_sets(df: DataFrame, value: str, sets: dict[str, list[str]]) -> DataFrame:
    """``stats_by`` for several sets of keys at once; see ``by_sets``."""
    spread = [F.min(value).alias(f"min_{value}"), F.max(value).alias(f"max_{value}")]
    return by_sets(df, sets, F.avg(value).alias(f"avg_{value}"), *spread, F.count(value).alias("count"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of all rows by value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)


def rows_per_day(df: DataFrame, days: int) -> Column:
    return F.count("*") / F.lit(days)


def days(df: DataFrame) -> DataFrame:
    """Every date with its rows, weekday and a holiday or weekend label.

    Expects ``date`` and ``holiday``; a holiday depends on the date alone, so it
    is carried through the same aggregation.
    """
    per_day = df.groupBy("date").agg(F.count("*").alias("n"), F.max("holiday").alias("holiday"))
    weekend = F.when(rules.weekend_flag(F.col("date")) == 1, "Weekend").otherwise("")
    return per_day.select(
        "date", rules.day_name(F.col("date")).alias("day_of_week"), "n", F.coalesce("holiday", weekend).alias("label")
    )


def busiest_days(df: DataFrame, k: int) -> DataFrame:
    """The k dates with most rows; ties go to the earlier date."""
    return days(df).orderBy(F.desc("n"), F.asc("date")).limit(k)


def summary(df: DataFrame, days: int) -> DataFrame:
    """One row: rows, rows per day, routes, mean price as text, date range as text."""
    return df.agg(
        F.count("*").alias("total_flights"),
        rows_per_day(df, days).alias("avg_flights_per_day"),
        F.count_distinct("route").alias("total_routes"),
        texts.plain_money(F.avg("price")).alias("avg_price"),
        F.concat_ws(" to ", F.min("date").cast("string"), F.max("date").cast("string")).alias("date_range"),
    )


def median(df: DataFrame, value: str) -> DataFrame:
    """The exact median as one row, for every ordered type; null and NaN are left out."""
    counts = df.groupBy(F.col(value).alias("x")).agg(F.count("*").alias("n"))
    return median_of_counts(counts, value)


def median_of_counts(counts: DataFrame, label: str = "value") -> DataFrame:
    """The exact median of values ``x`` that occur ``n`` times each.

    Equal values are counted in their own type, the counts ranged by value, and
    each range summed. Only ranges that hold a middle rank are ranked, and each
    by its own task. An even number of values gives the mean of the middle two:
    a double for floating point, a decimal otherwise.
    """
    kind = counts.schema["x"].dataType
    present = F.col("x").isNotNull()
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan("x")
    counts = counts.where(present).select("x", "n")
    ranged = stage(counts.repartitionByRange("x").withColumn("part", F.spark_partition_id()), f"ranges-{label}")
    # One row per range: as many as the exchange has partitions.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("part").agg(F.sum("n").alias("n"), F.min("x").alias("low"))
    sums = sums.select("part", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("below"))
    total = ranged.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    first, last = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    hit = sums.where((F.col("below") < last) & (F.col("below") + F.col("n") >= first)).select("part", "below")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("x")) + F.col("below")
    ranked = ranged.join(hit, "part").select("x", "n", upto.alias("upto"))
    middle = ranked.where((F.col("upto") >= first) & (F.col("upto") - F.col("n") < last))
    # Two values at most; one value stands for both ranks when it covers them.
    low, high = F.min("x"), F.max("x")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        mean = F.when(low == high, low).otherwise(low / 2 + high / 2)
    elif isinstance(kind, T.NumericType):
        whole = kind if isinstance(kind, T.DecimalType) else T.DecimalType(19, 0)
        wide = T.DecimalType(min(whole.precision + 2, 38), min(whole.scale + 1, 37))
        mean = (low.cast(wide) + (high.cast(wide) - low.cast(wide)) / 2).cast(wide)
    else:
        mean = low
    return middle.agg(mean.alias("median"))


@dataclass(frozen=True)
class Dropped:
    """How many rows were kept and dropped; known once the kept rows have been written or read in full."""

    seen: Observation
    spark: SparkSession

    def report(self) -> DataFrame:
        counts = self.seen.get
        row = (counts.get("kept_rows") or 0, counts.get("dropped_rows") or 0)
        return self.spark.createDataFrame([row], "kept_rows long, dropped_rows long")


def without_incomplete(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Dropped]:
    """Rows complete in the given columns, and the counts of kept and dropped rows.

    The rows are counted as they flow to whatever reads the result first, so
    counting costs no pass of its own. A field is incomplete if it is null or NaN.
    """
    schema = {f.name: f.dataType for f in df.schema}
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(name).isNotNull()
        if isinstance(schema[name], (T.DoubleType, T.FloatType)):
            complete = complete & ~F.isnan(name)
    seen = Observation()
    counted = df.observe(seen, F.count_if(complete).alias("kept_rows"), F.count_if(~complete).alias("dropped_rows"))
    return counted.where(complete), Dropped(seen, df.sparkSession)


@dataclass(frozen=True)
class Report:
    """The parts of a description of flights, from one aggregation over them."""

    parts: DataFrame
    days: int

    SETS: ClassVar = {"all": [], "airline": ["airline"], "class": ["class"], "route": ["route"], "date": ["date"], "price": ["price"]}

    @classmethod
    def of(cls, flights: DataFrame, days: int) -> Report:
        """Expects ``airline``, ``class``, ``route``, ``date`` and ``price``. Everything else is read from the staged result."""
        # Measures get copies of the keys: a key outside of its set is null for the measures too.
        rows = flights.select(*cls.SETS["airline"], "class", "route", "date", "price", F.col("class").alias("cabin"),
                              F.col("price").alias("paid"), F.col("date").alias("day"))
        mean_of = lambda name: F.avg(F.when(F.col("cabin") == name, F.col("paid")))
        measures = (
            F.count("*").alias("n"), F.avg("paid").alias("mean_price"), F.min("paid").alias("min_price"),
            F.max("paid").alias("max_price"), mean_of("Economy").alias("economy_mean"),
            mean_of("Business").alias("business_mean"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        )
        parts = stage(by_sets(rows, cls.SETS, *measures), "report")
        if parts.isEmpty():
            # Without rows there is no group, not even that of all rows; the whole is still to be described.
            parts = parts.unionByName(rows.agg(F.lit("all").alias("part"), *measures), allowMissingColumns=True)
        return cls(parts, days)

    def part(self, name: str) -> DataFrame:
        return self.parts.where(F.col("part") == name)

    def prices(self) -> DataFrame:
        return self.part("all").select("mean_price", "min_price", "max_price", "economy_mean", "business_mean")

    def shares(self, column: str) -> DataFrame:
        total = self.part(column).select(F.sum("n")).scalar()
        return self.part(column).select(column, "n", (F.col("n") / total).alias("share"))

    def top_routes(self, k: int) -> DataFrame:
        return self.part("route").select("route", "n").orderBy(F.desc("n"), F.asc("route")).limit(k)

    def summary(self) -> DataFrame:
        routes = self.part("route").select(F.count("route")).scalar()
        return self.part("all").select(
            F.col("n").alias("total_flights"),
            (F.col("n") / F.lit(self.days)).alias("avg_flights_per_day"),
            routes.alias("total_routes"),
            texts.plain_money(F.col("mean_price")).alias("avg_price"),
            F.concat_ws(" to ", F.col("first_day").cast("string"), F.col("last_day").cast("string")).alias("date_range"),
        )

    def median_price(self) -> DataFrame:
        return median_of_counts(self.part("price").select(F.col("price").alias("x"), "n"), "price")

    def busiest_days(self, calendar: DataFrame, k: int) -> DataFrame:
        """``calendar`` has ``date`` and ``holiday``, a date at most once."""
        labels = calendar.select("date", "holiday")
        weekend = F.when(rules.weekend_flag(F.col("date")) == 1, "Weekend").otherwise("")
        found = self.part("date").where(F.col("date").isNotNull()).select("date", "n").join(labels, "date", "left")
        named = found.select(
            "date", rules.day_name(F.col("date")).alias("day_of_week"), "n", F.coalesce("holiday", weekend).alias("label")
        )
        return named.orderBy(F.desc("n"), F.asc("date")).limit(k)


def approximate_median(df: DataFrame, value: str, keys: list[str] | None = None, rank_error: float = 0.001) -> DataFrame:
    """A value whose rank is off the middle by at most ``rank_error`` of the rows, for the whole table or by keys.

    A mergeable quantile summary per group: one aggregation with small state,
    where the exact median ranges all distinct values. Null and NaN are left
    out; a group without another value has a null median. The result is one of
    the values, in their type.
    """
    if not 0 < rank_error < 1:
        raise ValueError("the rank error is a share between 0 and 1")
    present = F.col(value)
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        present = F.when(~F.isnan(value), F.col(value))
    # The summary promises 1 / accuracy; rounding the rank takes part of that.
    accuracy = F.lit(math.ceil(2 / rank_error))
    return df.groupBy(*(keys or [])).agg(F.percentile_approx(present, 0.5, accuracy).alias("median"))
