"""Encoding in table form: label indexes, scaling, split and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from farekit.functions import rules
from farekit.session import stage


def index_table(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature, label, rows and index of each label, most frequent first, equal ones by label.

    All features are counted in one pass. The counted labels are dealt into
    ranges of their order, and each range ranks its own: a label's index is its
    place in the range plus the labels of its feature in earlier ranges. A
    vocabulary may be as large as the table; no task ranks a whole feature.
    """
    long = df.select(*features).unpivot([], features, "feature", "label")
    counts = long.where(F.col("label").isNotNull()).groupBy("feature", "label").agg(F.count("*").alias("n"))
    order = (F.desc("n"), F.asc("label"))
    dealt = counts.repartitionByRange("feature", *order).withColumn("part", F.spark_partition_id())
    ranged = stage(dealt, "label-ranges")
    # One row for each feature and range.
    earlier = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("feature", "part").agg(F.count("*").alias("size"))
    offsets = sizes.select("feature", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("feature", "part").orderBy(*order)) - 1
    ranked = ranged.withColumn("place", place).join(offsets, ["feature", "part"])
    return ranked.select("feature", "label", "n", (F.col("before") + F.col("place")).cast("int").alias("index"))


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_scaled``: the value over its sample standard deviation, not centred."""
    # One subquery for all columns, so the rows are read once more, not once per column.
    spread = df.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in columns]).alias("s")).scalar()
    return df.withColumns(
        {f"{c}_scaled": rules.price_ratio(F.col(c).cast("double"), spread.getField(c)) for c in columns}
    )


def in_training(key: Column, percent: int = 80) -> Column:
    """Whether a row belongs to the training part, from its key alone."""
    return rules.hash_bucket(key) < percent


def split(df: DataFrame, key: Column, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows; the same rows on every run and every retry."""
    return df.where(in_training(key, percent)), df.where(~in_training(key, percent))


def split_with_fallback(
    df: DataFrame, key: Column, shares: tuple[int, ...] = (90, 80), *, fallback: bool = False
) -> tuple[DataFrame, DataFrame, int]:
    """Training rows, held-out rows and the percentage of the split that made them.

    The first share, unless ``fallback`` is asked for: then the first that holds
    out two rows or more, and if none does, all rows twice under 100 percent.
    """
    if not fallback:
        return *split(df, key, shares[0]), shares[0]
    held_out = [F.count_if(~in_training(key, percent)).alias(str(percent)) for percent in shares]
    sizes = df.agg(*held_out).first()
    for percent in shares:
        if sizes[str(percent)] >= 2:
            return *split(df, key, percent), percent
    return df, df, 100


def regression_metrics(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """rmse, mae, r2, mean-relative error in percent and rows, all in one aggregation."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    scored = predictions.select(y.alias("y"), error.alias("e"))
    squares = F.sum(F.col("e") * F.col("e"))
    mae = F.avg(F.abs("e"))
    return scored.agg(
        F.sqrt(squares / F.count("e")).alias("rmse"),
        mae.alias("mae"),
        (1 - F.try_divide(squares, F.var_pop("y") * F.count("y"))).alias("r2"),
        (F.try_divide(mae, F.avg("y")) * 100).alias("error_percent"),
        F.count("*").alias("n"),
    )
