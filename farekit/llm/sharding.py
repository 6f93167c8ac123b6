"""A uniform shuffle into shards of exact size through a drawn communication matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farekit.llm.chance import hypergeometric
from farekit.llm.columns import let, unit_interval, without
from farekit.session import stage

SHARDS = 8
# Mean rows of a source partition and of an output block: what one task permutes at a time.
PARTITION_ROWS = 2048
# Source partitions whose part of the matrix one task draws.
GROUP_PARTITIONS = 1024
SEED = 20_240_601

ADDED = ("shard", "slot")


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that add up to ``rows`` and differ by one at most, larger ones first."""
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def _power_of_two(at_least: float) -> int:
    return 1 << max(0, int(-(-at_least // 1)) - 1).bit_length()


def _split_once(nodes: DataFrame, half: int, seed: int) -> DataFrame:
    """Divide each node's shard counts between the two halves of its partitions.

    The left half draws its rows from the node's without replacement: a
    multivariate hypergeometric draw, one shard after the other.
    """

    def left_counts(node: Column) -> Column:
        counts, sizes, path = node["counts"], node["sizes"], node["first"]
        of_left = F.aggregate(F.slice(sizes, 1, half), F.lit(0).cast("long"), lambda a, x: a + x)
        of_all = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(
            F.array().cast("array<long>").alias("drawn"), of_left.alias("open"), of_all.alias("rest")
        )

        def draw(acc: Column, i: Column) -> Column:
            marked = F.get(counts, i)
            u = unit_interval(F.lit(seed), F.lit(half), path, i)
            return let(
                F.struct(
                    acc["drawn"].alias("drawn"), acc["open"].alias("open"), acc["rest"].alias("rest"),
                    marked.alias("marked"), hypergeometric(u, acc["rest"], marked, acc["open"]).alias("x"),
                ),
                lambda s: F.struct(
                    F.concat(s["drawn"], F.array(s["x"])).alias("drawn"),
                    (s["open"] - s["x"]).alias("open"),
                    (s["rest"] - s["marked"]).alias("rest"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, draw, lambda acc: acc["drawn"])

    # Two columns stand for the node, so that the draw is one expression evaluated once a row.
    drawn = nodes.withColumn("left", left_counts(F.struct("counts", "sizes", "first")))
    rest = F.zip_with("counts", "left", lambda c, x: c - x)
    children = F.array(
        F.struct(F.col("first"), F.slice("sizes", 1, half).alias("sizes"), F.col("left").alias("counts")),
        F.struct((F.col("first") + half).alias("first"), F.slice("sizes", half + 1, half).alias("sizes"), rest.alias("counts")),
    )
    return drawn.select(F.inline(children))


def _divide(nodes: DataFrame, partitions: int, seed: int) -> DataFrame:
    """Rows (first, counts) of single partitions from nodes of ``partitions`` each, a power of two."""
    while partitions > 1:
        partitions //= 2
        nodes = _split_once(nodes, partitions, seed)
    return nodes.select("first", F.get("sizes", F.lit(0)).alias("rows"), "counts")


def communication_matrix(sizes: DataFrame, partitions: int, counts: list[int], seed: int = SEED) -> DataFrame:
    """How many rows each source partition sends to each shard: (part, counts).

    ``sizes`` has (part, n) of the non-empty partitions out of ``partitions``, a
    power of two; ``counts`` are the shard sizes. Drawing the halves of ever
    smaller ranges of partitions gives the same law as dealing out all rows at
    random: all row sums and column sums hold exactly. The upper part of that
    tree has a leaf for each group of GROUP_PARTITIONS and is drawn in one task,
    the lower parts by their groups.
    """
    inner = min(partitions, GROUP_PARTITIONS)
    group = F.floor(F.col("part") / inner)
    present = F.map_from_arrays(F.collect_list(F.col("part") % inner), F.collect_list("n"))
    by_group = sizes.groupBy(group.cast("long").alias("first")).agg(present.alias("present"), F.sum("n").alias("n"))
    inner_sizes = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(inner - 1).cast("long")),
        lambda i: F.coalesce(F.try_element_at("present", i), F.lit(0).cast("long")),
    )
    groups = by_group.select("first", inner_sizes.alias("sizes"), "n")
    outer = partitions // inner
    above = groups.groupBy().agg(F.map_from_arrays(F.collect_list("first"), F.collect_list("n")).alias("present"))
    outer_sizes = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(outer - 1).cast("long")),
        lambda i: F.coalesce(F.try_element_at("present", i), F.lit(0).cast("long")),
    )
    root = above.select(
        F.lit(0).cast("long").alias("first"),
        outer_sizes.alias("sizes"),
        F.array(*[F.lit(c).cast("long") for c in counts]).alias("counts"),
    )
    tops = _divide(root, outer, seed).select("first", "counts")
    nodes = groups.join(tops, "first").select((F.col("first") * inner).alias("first"), "sizes", "counts")
    leaves = _divide(nodes, inner, seed + 1)
    return leaves.where(F.col("rows") > 0).select(F.col("first").alias("part"), "counts")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    *,
    key: tuple[str, ...] = ("doc_id", "text"),
    partition_rows: int = PARTITION_ROWS,
) -> DataFrame:
    """The rows with ``shard`` and ``slot``: a uniformly random order cut into shards of exact size.

    Rows go to source partitions by a hash of ``key`` and are permuted there by
    a second hash. The communication matrix says how many of each partition's
    rows, in that order, go to each shard. In its shard a row goes to a block
    and a place in the block by a third hash, which permutes the shard; a block
    starts where the blocks before it end. ``slot`` counts from 0 without gaps.

    Shard sizes differ by one row at most. The same rows and seed give the same
    result whatever the cluster, except that rows with equal keys may swap
    places; such rows are shuffled like all others. Null keys are hashed like any value, an empty table stays empty, and
    existing columns ``shard`` and ``slot`` are replaced. No task sees more than
    a partition or a block, both of ``partition_rows`` rows in the mean.
    """
    names = [F.col(name) for name in key]
    rows = without(docs, *ADDED)

    def order(salt: int, *more: str) -> Column:
        return F.xxhash64(F.lit(seed + salt), *names, *[F.col(c) for c in more])

    total = docs.select(*key[:1]).count()
    partitions = _power_of_two(total / partition_rows)
    part = F.pmod(order(0), F.lit(partitions)).cast("long")
    sizes = docs.select(part.alias("part")).groupBy("part").agg(F.count("*").alias("n"))
    matrix = stage(communication_matrix(sizes, partitions, shard_sizes(total, shards), seed), "shard-matrix")
    upto = F.transform(
        F.sequence(F.lit(1), F.size("counts")),
        lambda i: F.aggregate(F.slice("counts", 1, i), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    ends = matrix.select(F.col("part").alias("__part"), upto.alias("__ends"))
    blocks = _power_of_two(total / shards / partition_rows)

    def sent(df: DataFrame) -> DataFrame:
        """Add __shard, __block and __second. Rows of equal keys are numbered, so that they part ways like any others."""
        alike = Window.partitionBy("__part", *names).orderBy(names[0])
        local = Window.partitionBy("__part").orderBy("__first", *names, "__copy")
        return (
            df.withColumn("__part", part)
            .withColumn("__copy", F.row_number().over(alike))
            .withColumn("__first", order(1, "__copy"))
            .withColumn("__rank", F.row_number().over(local))
            .join(ends, "__part")
            .withColumn("__shard", F.size(F.filter("__ends", lambda end: end < F.col("__rank"))).cast("int"))
            .withColumn("__second", order(2, "__copy"))
            .withColumn("__block", F.pmod(F.shiftright("__second", 40), F.lit(blocks)).cast("int"))
            .drop("__part", "__first", "__rank", "__ends")
        )

    # The block sizes come from the keys alone: a narrow pass, not another one over the rows.
    block_sizes = sent(docs.select(*dict.fromkeys(key))).groupBy("__shard", "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = block_sizes.select(
        F.col("__shard").alias("shard"), F.col("__block").alias("__of_block"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    within = Window.partitionBy("__shard", "__block").orderBy("__second", *names, "__copy")
    placed = sent(rows).withColumn("__place", F.row_number().over(within))
    same = (F.col("__shard") == F.col("shard")) & (F.col("__block") == F.col("__of_block"))
    joined = placed.join(stage(starts, "shard-blocks"), same)
    slot = (F.col("__start") + F.col("__place") - 1).cast("long")
    return joined.withColumn("slot", slot).select(*rows.columns, "shard", "slot")
