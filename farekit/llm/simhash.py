"""SimHash fingerprints, and near-duplicate groups found with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farekit.llm.components import components
from farekit.session import stage

SHINGLE = 4
RADIUS = 4
HASH_SEED = 42
BITS = 64
# Blocks of bits that two fingerprints within the radius are certain to share: the key of a shard of trees.
SHARED_BLOCKS = 2
# Mean number of fingerprints in one tree.
TREE_NODES = 2048

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_AT_ONCE = 65_536


def _shingles(body: bytes, size: int) -> Iterator[list[bytes]]:
    """The word shingles of a lower-cased text, space-joined, some thousand at a time."""
    tokens = body.translate(LOWER).split()
    if not tokens:
        return
    ends = np.cumsum([len(t) + 1 for t in tokens])
    joined = b" ".join(tokens)
    starts = np.concatenate([[0], ends[:-1]])
    size = min(size, len(tokens))
    spans = list(zip(starts[: len(starts) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True))
    for i in range(0, len(spans), _AT_ONCE):
        yield [joined[a:b] for a, b in spans[i : i + _AT_ONCE]]


def _majority(hashes: Iterator[np.ndarray], width: int) -> np.ndarray:
    """Bits set in more than half of the hashes (rows of bytes), as signed longs; zeros without hashes."""
    total, counts = 0, np.zeros(width, dtype=np.int64)
    for rows in hashes:
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(rows)
    return np.packbits(counts * 2 > total, bitorder="little").view(np.int64)


def simhash(body: bytes | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a UTF-8 text as a signed long; 0 for a text without a word.

    A bit is 1 if it is set in more than half of the XXH64 hashes of the text's
    word shingles, repeats included. A text of fewer words than ``size`` is one
    shingle.
    """
    hashes = (
        np.fromiter((xxhash.xxh64_intdigest(s, HASH_SEED) for s in part), np.uint64, len(part)).view(np.uint8).reshape(-1, 8)
        for part in _shingles(body or b"", size)
    )
    return int(_majority(hashes, BITS)[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """``simhash`` of a text column; null counts as empty."""

    @F.pandas_udf(T.LongType())
    def of_texts(bodies: pd.Series) -> pd.Series:
        return pd.Series([simhash(b, size) for b in bodies], dtype="int64")

    return of_texts(text.cast("binary"))


class BKTree:
    """Fingerprints under a root, each child keyed by its Hamming distance to its parent."""

    def __init__(self) -> None:
        self.prints: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, bits: int) -> None:
        self.prints.append(bits)
        self.children.append({})
        new, node = len(self.prints) - 1, 0
        while node != new:
            distance = (self.prints[node] ^ bits).bit_count()
            node = self.children[node].setdefault(distance, new)

    def near(self, bits: int, radius: int) -> list[int]:
        """Positions of all prints within ``radius``; only edges that the triangle inequality allows are followed."""
        found, open_nodes = [], [0] if self.prints else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (self.prints[node] ^ bits).bit_count()
            if distance <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius:
                    open_nodes.append(child)
        return found


class _Forest:
    """Union-find over positions; the root is the smallest position."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)


_UNSIGNED = (1 << BITS) - 1


def _link_shards(radius: int):
    """Search the trees of one shard with the fingerprints of another (or its own); give a spanning forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            froms, tos = [], []
            for row in batch.to_pylist():
                nodes, others = row["nodes"], row["others"] or []
                prints = [n["bits"] & _UNSIGNED for n in nodes + others]
                forest, tree = _Forest(len(prints)), BKTree()
                for i, bits in enumerate(prints):
                    inner = i < len(nodes)
                    # A shard against itself: each print asks those before it. Against another: only the others ask.
                    if not others or not inner:
                        for j in tree.near(bits, radius):
                            forest.join(i, j)
                    if inner:
                        tree.add(bits)
                ids = [n["node"] for n in nodes + others]
                for i in range(len(prints)):
                    if (r := forest.root(i)) != i:
                        froms.append(ids[i])
                        tos.append(ids[r])
            yield pa.RecordBatch.from_arrays([pa.array(froms, pa.int64()), pa.array(tos, pa.int64())], names=["a", "b"])

    return run


def _block_keys(bits: Column, radius: int, shared: int) -> Column:
    """The values of every choice of ``shared`` out of radius + shared blocks of bits, as (choice, value)."""
    blocks = radius + shared
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:], strict=False)]
    keys = []
    for choice, parts in enumerate(combinations(masks, shared)):
        mask = sum(parts)
        signed = mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask
        keys.append(F.struct(F.lit(choice).alias("choice"), bits.bitwiseAND(F.lit(signed)).alias("value")))
    return F.array(*keys)


def linked(nodes: DataFrame, radius: int = RADIUS, *, shared: int = SHARED_BLOCKS) -> DataFrame:
    """(node, root) of all rows (node, bits) that link to another; root is the smallest node reachable.

    Two rows link if ``bits`` differ in ``radius`` places at most. ``node`` must
    tell rows apart.

    Prints within the radius agree in ``shared`` of radius + shared blocks of
    their bits, so each choice of blocks keys a shard of prints. A shard is one
    BK-tree, or several of TREE_NODES in the mean if a key is frequent; then
    every tree of the key meets the prints of every other. The trees travel by
    key instead of by broadcast, which would grow with the corpus. Links inside
    one meeting are reduced to a spanning forest before they leave the task, so
    a dense group gives as many links as it has rows, not their square.
    """
    keyed = nodes.select("node", "bits", F.inline(_block_keys(F.col("bits"), radius, shared)))
    counts = keyed.groupBy("choice", "value").agg(F.count("*").alias("n")).where("n > 1")
    counts = stage(counts, "shard-counts").withColumnsRenamed({"choice": "__choice", "value": "__value"})
    member = F.struct("node", "bits")
    shards = (
        keyed.join(counts, (F.col("choice") == F.col("__choice")) & (F.col("value") == F.col("__value")))
        .withColumn("shard", F.pmod(F.xxhash64("bits"), F.ceil(F.col("n") / TREE_NODES)))
        .groupBy("choice", "value", "shard", F.ceil(F.col("n") / TREE_NODES).alias("shards"))
        .agg(F.sort_array(F.collect_list(member)).alias("nodes"))
    )
    shards = stage(shards, "shards")
    alone = shards.select("nodes", F.lit(None).cast(shards.schema["nodes"].dataType).alias("others"))
    many = shards.where("shards > 1")
    others = many.select(
        F.col("choice").alias("__choice"), F.col("value").alias("__value"), F.col("shard").alias("__shard"),
        F.col("nodes").alias("others"),
    )
    meets = (
        (F.col("choice") == F.col("__choice")) & (F.col("value") == F.col("__value")) & (F.col("shard") < F.col("__shard"))
    )
    pairs = many.join(others, meets).select("nodes", "others")
    edges = alone.union(pairs).mapInArrow(_link_shards(radius), "a long, b long")
    return components(stage(edges, "links"))


def _members(prints: DataFrame, low: Column, radius: int) -> tuple[DataFrame, DataFrame]:
    """The different fingerprints with the root of their component, and the smallest ``low`` of each root.

    Copies share one fingerprint, which is searched once.
    """
    distinct = prints.groupBy("bits").agg(F.min(low).alias("low"))
    roots = stage(linked(distinct.select(F.col("bits").alias("node"), "bits"), radius), "roots")
    with_root = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "low", F.coalesce("root", "bits").alias("root")
    )
    return with_root, stage(with_root.groupBy("root").agg(F.min("low").alias("low")), "lowest")


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, bits, component_id) of every document.

    Documents link if their fingerprints differ in ``radius`` bits at most;
    component_id is the smallest doc_id a document reaches, itself included.
    Null and blank texts have fingerprint 0 and link like any others. A null
    doc_id is never a component_id unless its whole component has none.
    Repeated rows stay. Copies share one fingerprint, which is searched once.
    """
    prints = stage(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("bits")), "prints")
    with_root, lowest = _members(prints, F.col("doc_id"), radius)
    members = stage(
        with_root.join(lowest.select(F.col("root").alias("__root"), F.col("low").alias("component_id")), F.col("root") == F.col("__root"))
        .select(F.col("bits").alias("__bits"), "component_id"),
        "members",
    )
    return prints.join(members, F.col("bits") == F.col("__bits")).select("doc_id", "bits", "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group of ``grouped``, with the columns it came with.

    The smallest doc_id of a group stays, null last; of equal ids the one with
    the smaller hash of id and text, of equal rows one. All texts without a word
    are one group with whatever their fingerprint 0 links to. Texts of any
    length are read whole. An empty table stays empty.
    """
    row = F.xxhash64("doc_id", "text")
    prints = stage(docs.select("doc_id", row.alias("row"), fingerprint(F.col("text"), shingle).alias("bits")), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    _, lowest = _members(prints, order, radius)
    kept = stage(lowest.select(F.col("low.row").alias("__kept")), "kept")
    # The row hash covers id and text, so copies of a hot text spread; only repeated rows meet in the window.
    again = Window.partitionBy("__row").orderBy("__kept")
    return (
        docs.withColumn("__row", row)
        .join(kept, F.col("__row") == F.col("__kept"))
        .withColumn("__again", F.row_number().over(again))
        .where("__again = 1")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
