"""Mix sources to target weights by repeating and dropping whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farekit.llm.columns import without, word_count
from farekit.session import stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"

ADDED = ("size", "source_size", "target", "rate", "copies")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Target size of each source, from rows of (source, source_size).

    Sources in code-point order, null last, take the weights in turn. They
    divide ``share`` of all sizes by weight. No target exceeds ``most`` times
    its source's size; what is cut off goes to the others by weight until none
    exceeds. That fixed point is one level per unit of weight, found by ranking
    the sources by the level at which each is full.

    One row per source is ranked, never the documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.select(
        "source", "source_size", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight")
    ).withColumn("full_at", F.col("source_size") * most / F.col("weight"))
    upto = Window.orderBy("full_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = weighted.select(
        "*",
        (F.sum("source_size").over(upto) * most).alias("full_below"),
        (F.sum("weight").over(whole) - F.sum("weight").over(upto)).alias("open_above"),
        (F.sum("source_size").over(whole) * share).alias("wanted"),
    )
    # A source is full if everyone at or below it being full still leaves its level or more to those above.
    is_full = F.col("full_below") + F.col("open_above") * F.col("full_at") <= F.col("wanted")
    marked = ranked.select("*", is_full.alias("is_full"))
    full = F.sum(F.when(F.col("is_full"), F.col("source_size")).otherwise(0)).over(whole) * most
    open_weight = F.sum(F.when(F.col("is_full"), 0.0).otherwise(F.col("weight"))).over(whole)
    level = F.try_divide(F.col("wanted") - full, open_weight)
    target = F.when(F.col("is_full"), F.col("source_size") * most).otherwise(F.col("weight") * level)
    return marked.select("source", "source_size", target.alias("target"))


def chance(seed: str, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from the document alone, the same in any engine with md5."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") / F.lit(float(16**12))


def _rated(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: str) -> DataFrame:
    """The documents with the private columns __size, __source_size, __target, __rate and __copies."""
    sized = docs.withColumn("__size", word_count(F.col("text")))
    totals = sized.groupBy("source").agg(F.sum("__size").alias("source_size"))
    targets = stage(source_targets(totals, weights, share, most), "mix-targets").select(
        F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target")
    )
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    rate = F.coalesce(F.try_divide(F.col("__target"), F.col("__source_size")), F.lit(0.0))
    extra = chance(seed, F.col("doc_id"), F.col("text")) < F.col("__rate") - F.floor("__rate")
    return joined.withColumn("__rate", rate).withColumn("__copies", F.floor("__rate") + extra.cast("long"))


def with_copies(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Each document with how many copies of it the mix takes.

    Adds size (words), source_size, target (of its source), rate (target over
    source_size, 0 for an empty source) and copies: floor(rate), plus one when
    the document's own number in [0, 1) is below the fraction. Existing columns
    of these names are replaced.

    A null text has size 0. A null source is a source of its own. Equal rows
    get equal numbers. An empty table stays empty. Sizes are summed before the
    shuffle, so a hot source is no hot task, and the table of sources is
    written first: its true size decides whether the join is a broadcast.
    """
    rated = _rated(docs, weights, share, most, seed)
    return without(rated, *ADDED).withColumnsRenamed({f"__{name}": name for name in ADDED})


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The documents, each as often as the mix takes it, with the columns they came with."""
    taken = _rated(docs, weights, share, most, seed).where(F.col("__copies") > 0)
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
