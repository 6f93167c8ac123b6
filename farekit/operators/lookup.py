"""Lookups against vocabularies and dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DISTANCE_KM = 1000.0


def distance_between(df: DataFrame, distances: DataFrame, source: Column, destination: Column) -> DataFrame:
    """Attach ``lookup_km``: the known distance in either direction, else the default."""
    keyed = df.withColumns(
        {"city_a": F.least(source, destination), "city_b": F.greatest(source, destination)}
    )
    joined = keyed.join(distances, ["city_a", "city_b"], "left")
    return joined.withColumn("lookup_km", F.coalesce("known_km", F.lit(DEFAULT_DISTANCE_KM))).drop(
        "city_a", "city_b", "known_km"
    )


def distinct_values(df: DataFrame, *columns: str, name: str = "value") -> DataFrame:
    """The distinct non-null values seen in any of the columns, from one pass over the rows."""
    values = df.select(F.explode(F.array(*columns)).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()


def known_only(df: DataFrame, vocabulary: DataFrame, column: str) -> DataFrame:
    """Rows whose value is in the one-column vocabulary."""
    return df.join(vocabulary.toDF(column), column, "left_semi")


def unknown_only(df: DataFrame, vocabulary: DataFrame, column: str) -> DataFrame:
    """Rows whose value is missing from the one-column vocabulary; null counts as missing."""
    return df.join(vocabulary.toDF(column), column, "left_anti")


def mark_known(df: DataFrame, vocabulary: DataFrame, column: str, flag: str) -> DataFrame:
    """Attach a boolean that tells whether the value is in the vocabulary."""
    marks = vocabulary.toDF(column).withColumn(flag, F.lit(True))
    return df.join(marks, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
