"""Baseline prices and price ratios of quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.functions import rules
from farekit.operators.profile import stats_by
from farekit.session import stage

BASELINE_DAYS_LEFT = 1


def baseline_prices(quotes: DataFrame, by_class: bool = False) -> DataFrame:
    """Mean price of the quotes one day ahead by flight, all classes together unless asked."""
    keys = ["flight", "classx"] if by_class else ["flight"]
    last_day = quotes.where(F.col("days_left") == BASELINE_DAYS_LEFT)
    return last_day.groupBy(*keys).agg(F.avg("price").alias("baseline_price"))


def with_baseline(quotes: DataFrame, by_class: bool = False) -> DataFrame:
    """Quotes with their baseline; flights without a one-day quote drop out."""
    # Read twice, for the small aggregate and for the join: staged once, so the rows are made once.
    quotes = stage(quotes, "quotes")
    baseline = stage(baseline_prices(quotes, by_class), "baseline")
    return quotes.join(baseline, ["flight", "classx"] if by_class else "flight", "inner")


def with_ratio(quotes: DataFrame, by_class: bool = False) -> DataFrame:
    return with_baseline(quotes, by_class).withColumn(
        "price_ratio", rules.price_ratio(F.col("price"), F.col("baseline_price"))
    )


def baselines_of_stats(stats: DataFrame) -> DataFrame:
    """The baselines out of price statistics by flight and lead time, without another pass over the quotes."""
    last_day = stats.where(F.col("days_left") == BASELINE_DAYS_LEFT)
    return last_day.select("flight", F.col("avg_price").alias("baseline_price"))


def with_ratio_to(quotes: DataFrame, bases: DataFrame) -> DataFrame:
    """Quotes with the ratio of their price to a known baseline of the flight; flights without one drop out."""
    ratio = rules.price_ratio(F.col("price"), F.col("baseline_price"))
    return quotes.join(bases, "flight").withColumn("price_ratio", ratio)


def ratio_stats(ratios: DataFrame) -> DataFrame:
    return stats_by(ratios, "price_ratio", ["days_left", "classx"])


def scenario_grid(bases: DataFrame, lead_times: list[int], classes: list[str]) -> DataFrame:
    """Every lead time and class for each base row.

    The grid is exploded from literals inside each row, so it needs no join.
    """
    lead = F.explode(F.array(*[F.lit(days) for days in lead_times]))
    cabin = F.explode(F.array(*[F.lit(name) for name in classes]))
    return bases.withColumn("days_left", lead).withColumn("classx", cabin)
