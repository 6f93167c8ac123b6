"""What each filter removes under every order of the filters, by difference arrays over ranks of permutations.

A document that fails the filters in a mask is removed by the first of them in
an order. Orders in lexicographic order are numbered by their Lehmer code, so
all orders that begin alike have consecutive ranks. The orders in which a mask
is removed at step s by filter f begin with s - 1 filters outside the mask and
then f: a few intervals of ranks. Every (part, mask) adds its counts where such
an interval begins and takes them away where it ends; running sums over the
ranks then give the totals of all orders. Documents are counted once by part
and mask, whatever the number of orders.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farekit.llm.columns import words
from farekit.session import stage

FILTERS = "ABCDE"
# Limits of the five failure conditions.
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_UPPER_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("docs", "good", "toxic")


def orders(names: str = FILTERS) -> list[str]:
    """All orders of the filters; the place in the list is the Lehmer rank."""
    return ["".join(p) for p in permutations(sorted(names))]


def lehmer_rank(prefix: str, names: str = FILTERS) -> int:
    """The rank of the first order that begins with ``prefix``."""
    left, rank = sorted(names), 0
    for i, name in enumerate(prefix):
        rank += left.index(name) * factorial(len(names) - 1 - i)
        left.remove(name)
    return rank


def removal_intervals(names: str = FILTERS) -> list[tuple[int, int, str, int, int]]:
    """(mask, step, filter, begin, end): in the orders of ranks begin to end - 1 a mask goes at that step by that filter."""
    names = "".join(sorted(names))
    rows = []
    for mask in range(1, 1 << len(names)):
        failing = [f for i, f in enumerate(names) if mask >> i & 1]
        passing = [f for f in names if f not in failing]
        for step in range(1, len(passing) + 2):
            span = factorial(len(names) - step)
            for before in permutations(passing, step - 1):
                for name in failing:
                    begin = lehmer_rank("".join((*before, name)), names)
                    rows.append((mask, step, name, begin, begin + span))
    return rows


def failures(text: Column) -> list[Column]:
    """Conditions A to D on a text that is not null; E looks at the other documents."""
    found = words(text)
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return [
        F.size(found) < LEAST_WORDS,
        F.size(F.array_distinct(found)) * 100 < F.size(found) * LEAST_DISTINCT_PERCENT,
        upper.cast("long") * 100 > F.length(text).cast("long") * MOST_UPPER_PERCENT,
        text.rlike(SYMBOLS),
    ]


def with_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every document: bit i of the mask is set if it fails the filter of letter i.

    Texts leave the scan as four flags and a SHA-256. Only hashes that several
    rows share are joined back; both sides of that join are staged tables, so a
    hash that a third of all rows share is split by adaptive execution.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(text))), F.lit(0))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        bits.cast("int").alias("own"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    narrow = stage(narrow, "audit-narrow")
    shared = narrow.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = stage(shared.select(F.col("digest").alias("__digest"), "first"), "audit-shared")
    joined = narrow.join(firsts, F.col("digest") == F.col("__digest"), "left")
    # A null id is larger than any other, and no smaller than another null.
    later = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    return joined.select("doc_id", "part", (F.col("own") + F.when(later, 16).otherwise(0)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the filters they fail; at most 32 rows a part."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id"))
    marks = marks.agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    joined = masks.join(marks, F.col("doc_id") == F.col("__id"), "left")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    return joined.groupBy("part", "mask").agg(F.count("*").alias("docs"), *sums)


def totals(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from the counts by part and mask."""
    spark, n_orders, steps = counts.sparkSession, factorial(len(FILTERS)), len(FILTERS)
    counts = stage(counts, "audit-counts")
    # A fixed table of a few hundred intervals, whatever the data.
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, filter string, begin int, end int")
    hits = counts.join(F.broadcast(intervals), "mask").select("part", "step", "begin", "end", *COUNTS)
    at_begin = hits.select("part", "step", F.col("begin").alias("rank"), *COUNTS)
    at_end = hits.where(F.col("end") < n_orders).select(
        "part", "step", F.col("end").alias("rank"), *[(-F.col(c)).alias(c) for c in COUNTS]
    )
    # Every cell of the arrays exists, also where nothing happens.
    cells = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    cells = cells.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(n_orders - 1))).alias("rank"))
    zeros = cells.select("*", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    differences = zeros.union(at_begin).union(at_end).groupBy("part", "step", "rank")
    differences = differences.agg(*[F.sum(c).alias(c) for c in COUNTS])
    # 120 rows in each window.
    upto = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = differences.select("part", "step", "rank", *[F.sum(c).over(upto).alias(c) for c in COUNTS])

    order = F.get(F.array(*[F.lit(o) for o in orders()]), F.col("rank"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    named = removed.withColumn("filter_order", order).withColumn("filter", letter)
    bit = lambda i: F.col("mask").bitwiseAND(1 << i)
    of_filter = lambda name, condition: [
        F.sum(F.when(condition(i), F.col("docs")).otherwise(0)).alias(f"{name}_{f}") for i, f in enumerate(FILTERS)
    ]
    parts = counts.groupBy(F.col("part").alias("__part")).agg(
        F.sum("docs").alias("all_docs"),
        *of_filter("fails", lambda i: bit(i) != 0),
        *of_filter("only", lambda i: F.col("mask") == 1 << i),
    )
    parts = stage(parts, "audit-parts")
    pick = lambda name: F.get(F.array(*[F.col(f"{name}_{f}") for f in FILTERS]), F.ascii("filter") - ord("A"))
    done = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    every_order = Window.partitionBy("part", "filter")
    joined = named.join(parts, F.col("part") == F.col("__part"))
    return joined.select(
        "part", "filter_order", "step",
        (F.col("all_docs") - F.sum("docs").over(done)).alias("kept"),
        F.col("docs").alias("removed"),
        # A document that fails this step's filter goes here at the latest.
        (pick("fails") - F.col("docs")).alias("redundant"),
        pick("only").alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("docs").over(every_order).alias("shapley"),
    )


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    600 rows for each source: 120 orders of five filters, five steps each. A
    null source is the empty one. A null text is empty; it fails A, and E if an
    earlier document is empty too. E compares whole texts by SHA-256 with those
    of smaller ids; rows of equal id do not remove each other, so repeated rows
    count as often as they stand, and a null id comes after all others. Of
    repeated labels of a document any 1 counts; null labels, and labels of other
    values, are none. An empty table gives no row. Texts of any length are read
    whole. Extra columns are ignored, whatever their names.
    """
    return totals(mask_counts(with_masks(docs.select("doc_id", "text", "source")), labels))
