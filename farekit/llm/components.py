"""Connected components of an edge table by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farekit.session import stage


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
    return tuple(row)


def _lowest_neighbours(edges: DataFrame, label: str) -> DataFrame:
    """(node, low): the smallest of each node and its neighbours, as a table of known size."""
    return stage(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("low")), label)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the smallest node of its component.

    Two steps alternate until no edge changes: every node hangs its larger
    neighbours on its smallest one, then its smaller neighbours. Each round is
    two aggregations and joins on staged tables; the number of rounds grows
    with the logarithm of the diameter. Only three numbers a round reach the
    driver. Loops are ignored, repeated edges count once.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stage(ordered, "edges")
    before = _fingerprint(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest_neighbours(both, "low-large")
        larger = both.where("b > a").join(low, F.col("a") == F.col("node"))
        large = stage(larger.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "edges-large")
        low = _lowest_neighbours(large, "low-small")
        smaller = large.join(low, F.col("a") == F.col("node"))
        small = smaller.select("b", "low").union(low.select("node", "low")).toDF("a", "b").where("a <> b").distinct()
        current = stage(small, "edges-small")
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
