"""k-means over integer vectors, with distance bounds that planar geometry keeps tight as centroids move.

Every vector carries an upper bound of the distance to its own centroid and one
lower bound for all others. When centroids move, the upper bound grows by the
own centroid's drift. The lower bound would have to give way by the full drift
of the others; but the vectors of a cluster lie in a sphere around their old
centroid, and seen from there most drift is sideways. How much nearer a moved
centroid can have come to any point of the sphere is a question in the plane of
the sphere's centre and the drift's line, and its answer is often far less than
the drift, or negative. A vector whose bounds still part needs no distance at
all; one whose exact distance to its own centroid settles it needs one; only
the rest is scanned, in integers.

Vectors are packed into blocks and written once, bucketed by block. The bounds
are a small table bucketed alike, written anew each round, so a round joins the
two without a shuffle and reads each vector once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farekit.session import stage, stage_bucketed

CLUSTERS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = "3"
# Vectors in a block: half a megabyte in most cases.
BLOCK = 4096
# Pieces of a drift's line that are bounded one by one.
PIECES = 16
# Differences below this square into sums that fit 64 bits.
_PLAIN = 1 << 27
# Relative and absolute slack that covers the rounding of bounds.
_SLACK = 1e-6

_BLOCKS = "block long, ids binary, nulls binary, width int, values binary"
_STATE = "block long, cluster binary, upper binary, lower binary, scanned long, parts array<struct<cluster:int,n:long,radius:double,high:array<long>,low:array<long>>>"
_ASSIGNED = "vec_id long, cluster int, distance long"


# --- bounds ------------------------------------------------------------------------------------------------------


def loosening(old: np.ndarray, new: np.ndarray, centre: np.ndarray, radius: float, pieces: int = PIECES) -> float:
    """The most by which any point of a sphere can have come nearer to a centroid that moved from ``old`` to ``new``.

    While the centroid moves along its line, the distance to a point shrinks by
    the cosine of the angle at which the point is seen. All points of the
    sphere are seen within arcsin(radius / distance) of its centre. Each piece
    of the line takes the largest cosine that its ends allow. Never more than
    the drift; negative if the centroid moved away from the whole sphere.
    """
    drift = float(np.linalg.norm(new - old))
    if drift == 0.0:
        return 0.0
    to_centre = centre - old
    along = float(to_centre @ (new - old)) / drift
    off = math.sqrt(max(float(to_centre @ to_centre) - along * along, 0.0))
    ends = np.linspace(0.0, drift, pieces + 1)
    nearest = np.hypot(off, along - np.clip(along, ends[:-1], ends[1:]))
    seen = np.arctan2(off, along - ends[:-1])
    outside = radius < nearest
    spread = np.where(outside, np.arcsin(np.divide(radius, nearest, out=np.ones(pieces), where=outside)), np.pi)
    return float(np.sum(np.diff(ends) * np.cos(np.maximum(seen - spread, 0.0))))


@dataclass(frozen=True)
class Move:
    """Where the centroids are, how far each moved, and by how much each cluster's lower bound gives way."""

    centroids: list[list[int]]
    drift: list[float]
    give: list[float]

    @classmethod
    def between(cls, old: list[list[int]], new: list[list[int]], radius: list[float], tight: bool = True) -> Move:
        a, b = np.array(old, dtype=np.float64), np.array(new, dtype=np.float64)
        drift = np.linalg.norm(b - a, axis=1)
        give = []
        for i, r in enumerate(radius):
            others = [j for j in range(len(new)) if j != i]
            most = [loosening(a[j], b[j], a[i], r) if tight else drift[j] for j in others]
            give.append(max(most, default=0.0))
        return cls(new, drift.tolist(), give)

    @classmethod
    def start(cls, centroids: list[list[int]]) -> Move:
        return cls(centroids, [0.0] * len(centroids), [0.0] * len(centroids))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype("<f4"), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype("<f4"), np.float32(-np.inf))


def _squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances; Python integers where 64 bits could overflow."""
    difference = vectors - centroid
    return (difference * difference).sum(axis=1)


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def settle(
    vectors: np.ndarray, move: Move, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, upper and lower bound, and how many vectors were scanned in full.

    ``state`` has the same three of the centroids before the move. Ties go to
    the centroid of the smaller number.
    """
    centroids = np.array(move.centroids, dtype=vectors.dtype)
    if state is None:
        cluster = np.zeros(len(vectors), dtype=np.uint8)
        upper, lower = np.zeros(len(vectors)), np.zeros(len(vectors))
        open_ = np.arange(len(vectors))
    else:
        cluster = state[0].copy()
        upper = state[1].astype(np.float64) + np.array(move.drift)[cluster]
        give = np.array(move.give)[cluster]
        lower = state[2].astype(np.float64) - give - _SLACK * (1 + np.abs(give))
        open_ = np.flatnonzero(upper * (1 + _SLACK) + _SLACK >= lower)
        for c in np.unique(cluster[open_]).tolist():
            mine = open_[cluster[open_] == c]
            upper[mine] = _root(_squared(vectors[mine], centroids[c]))
        open_ = open_[upper[open_] * (1 + _SLACK) + _SLACK >= lower[open_]]
    if len(open_):
        every = np.stack([_squared(vectors[open_], c) for c in centroids], axis=1)
        nearest = every.argmin(axis=1)
        cluster[open_] = nearest
        upper[open_] = _root(every[np.arange(len(open_)), nearest])
        if len(centroids) > 1:
            every.sort(axis=1)
            lower[open_] = _root(every[:, 1])
        else:
            lower[open_] = np.inf
    return cluster, _up(upper), _down(lower), len(open_)


# --- blocks ------------------------------------------------------------------------------------------------------


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, x): floor(1024 * component), of the vectors that are whole and finite."""
    value = F.col("embedding")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    kept = vectors.where(value.isNotNull() & (F.size(value) == dimensions) & finite)
    scaled = F.transform(value, lambda v: F.floor(v.cast("double") * float(SCALE)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<long>").alias("x"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, blocks = TaskContext.get().partitionId(), 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            ids, values = part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False)
            largest = int(max(values.max(), -(values.min() + 1))) if len(values) else 0
            width = 2 if largest < 1 << 15 else 4 if largest < 1 << 31 else 8
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "block": (task << 32) + blocks,
                        "ids": np.array([i or 0 for i in ids.to_pylist()], dtype="<i8").tobytes(),
                        "nulls": np.array([i is None for i in ids.to_pylist()]).tobytes(),
                        "width": width,
                        "values": values.astype(f"<i{width}").tobytes(),
                    }
                ],
                schema=pa.schema(
                    [("block", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("width", pa.int32()), ("values", pa.binary())]
                ),
            )
            blocks += 1


def _vectors(row: dict, move: Move) -> np.ndarray:
    """The vectors of a block; as Python integers if distances could overflow 64 bits."""
    values = np.frombuffer(row["values"], f"<i{row['width']}").astype(np.int64).reshape(len(row["ids"]) // 8, -1)
    ends = [*values.max(axis=0, initial=0).tolist(), *values.min(axis=0, initial=0).tolist(), *sum(move.centroids, [])]
    return values.astype(object) if max(map(abs, ends)) >= _PLAIN else values


def _state_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    if row.get("cluster") is None:
        return None
    return np.frombuffer(row["cluster"], "u1"), np.frombuffer(row["upper"], "<f4"), np.frombuffer(row["lower"], "<f4")


_PART = pa.struct(
    [
        ("cluster", pa.int32()), ("n", pa.int64()), ("radius", pa.float64()), ("high", pa.list_(pa.int64())),
        ("low", pa.list_(pa.int64())),
    ]
)
_STATE_SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("cluster", pa.binary()), ("upper", pa.binary()), ("lower", pa.binary()),
        ("scanned", pa.int64()), ("parts", pa.list_(_PART)),
    ]
)


def _changes(vectors: np.ndarray, before: np.ndarray | None, after: np.ndarray, upper: np.ndarray, k: int) -> list[dict]:
    """By cluster: how its size and its sums change, and the radius of its members."""
    parts = []
    for c in range(k):
        now = after == c
        came, went = (now, None) if before is None else (now & (before != c), (before == c) & ~now)
        total, n = vectors[came].sum(axis=0), int(came.sum())
        if went is not None:
            total, n = total - vectors[went].sum(axis=0), n - int(went.sum())
        total = [int(x) for x in np.atleast_1d(total)]
        # In two halves, so that sums over all blocks fit 64 bits.
        parts.append(
            {
                "cluster": c, "n": n, "radius": float(upper[now].max()) if now.any() else 0.0,
                "high": [x >> 32 for x in total], "low": [x & 0xFFFFFFFF for x in total],
            }
        )
    return parts


def _round(move: Move):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                vectors, state = _vectors(row, move), _state_of(row)
                cluster, upper, lower, scanned = settle(vectors, move, state)
                parts = _changes(vectors, None if state is None else state[0], cluster, upper, len(move.centroids))
                told = {
                    "block": row["block"], "cluster": cluster.tobytes(), "upper": upper.tobytes(), "lower": lower.tobytes(),
                    "scanned": scanned, "parts": parts,
                }
                yield pa.RecordBatch.from_pylist([told], schema=_STATE_SCHEMA)

    return run


def _final(move: Move):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                vectors = _vectors(row, move)
                cluster, *_ = settle(vectors, move, _state_of(row))
                centroids = np.array(move.centroids, dtype=vectors.dtype)
                squared = np.zeros(len(vectors), dtype=vectors.dtype)
                for c in np.unique(cluster).tolist():
                    squared[cluster == c] = _squared(vectors[cluster == c], centroids[c])
                most = (1 << 63) - 1
                distance = pa.array([min(int(d), most) for d in squared] if squared.dtype == object else squared, pa.int64())
                ids = pa.array(np.frombuffer(row["ids"], "<i8"), mask=np.frombuffer(row["nulls"], "?"))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster.astype(np.int32)), distance], names=["vec_id", "cluster", "distance"]
                )

    return run


class _Bucketed:
    """A table by block whose files line up with those of every other such table of the same run."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.parts = spark, int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame, label: str) -> DataFrame:
        return stage_bucketed(df, label, "block", self.parts)


# --- the fit -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    blocks: DataFrame
    state: DataFrame | None
    move: Move
    scanned: list[int]


def _seeds(numbers: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors of smallest hash: as many as there are clusters, whatever the table."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = numbers.select(digest.alias("digest"), "x").orderBy(F.asc_nulls_last("digest"), "x").limit(clusters)
    return [list(r.x) for r in chosen.collect()]


def _sums(state: DataFrame, dimensions: int) -> dict[int, tuple[int, float, list[int]]]:
    """Change of size, radius and change of sums by cluster: one row a cluster reaches the driver."""
    parts = state.select(F.inline("parts")).groupBy("cluster")
    each = [F.sum(F.get(F.col(half), F.lit(i))).alias(f"{half}{i}") for half in ("high", "low") for i in range(dimensions)]
    rows = parts.agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), *each).collect()
    return {r.cluster: (r.n, r.radius, [(r[f"high{i}"] << 32) + r[f"low{i}"] for i in range(dimensions)]) for r in rows}


def fit(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED,
    *, tight: bool = True,
) -> Fit:
    """Centroids after ``rounds`` rounds. ``tight=False`` gives lower bounds way by the full drift, for comparison."""
    tables = _Bucketed(vectors.sparkSession)
    numbers = integer_vectors(vectors, dimensions)
    packed = numbers.mapInArrow(_pack, _BLOCKS).repartition(tables.parts, "block")
    blocks = tables.write(packed, "vectors")
    centroids = _seeds(numbers, clusters, seed)
    move, state, scanned = Move.start(centroids), None, []
    sizes, sums = [0] * len(centroids), [[0] * dimensions for _ in centroids]
    for _ in range(rounds if centroids else 0):
        state = tables.write(_joined(blocks, state).mapInArrow(_round(move), _STATE), "bounds")
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        changes = _sums(state, dimensions)
        radius = []
        for c in range(len(centroids)):
            n, r, change = changes[c]
            sizes[c] += n
            sums[c] = [a + b for a, b in zip(sums[c], change, strict=True)]
            radius.append(r)
        moved = [[x // n for x in s] if n else c for s, n, c in zip(sums, sizes, centroids, strict=True)]
        move, centroids = Move.between(centroids, moved, radius, tight), moved
    return Fit(blocks, state, move, scanned)


def _joined(blocks: DataFrame, state: DataFrame | None) -> DataFrame:
    if state is None:
        return blocks
    return blocks.join(state.select("block", "cluster", "upper", "lower"), "block")


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every whole, finite vector.

    Vectors are floor(1024 * component); a vector that is null, of another
    length, or has a null or non-finite component is left out. Centroids start
    as the vectors of smallest SHA-256 of ``seed:vec_id`` (null ids last, equal
    ids by their components; fewer vectors give fewer centroids), and repeated
    rows count as often as they stand. Equal distances go to the centroid of
    the smaller number; an empty cluster keeps its centroid. Distances are
    exact and squared; those over 2^63 - 1 are given as that. Sums over a
    cluster or all vectors are null where they exceed it. An empty table gives
    no row. Extra columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    found = fit(vectors.select("vec_id", "embedding"), clusters, rounds, dimensions, seed)
    if not found.move.centroids:
        schema = f"{_ASSIGNED}, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    assigned = stage(_joined(found.blocks, found.state).mapInArrow(_final(found.move), _ASSIGNED), "assigned")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).try_cast("long")
    inertias = stage(assigned.groupBy("cluster").agg(wide("distance").alias("cluster_inertia")), "inertias")
    digests = F.array(*[F.lit(centroid_digest(c)) for c in found.move.centroids])
    by_cluster = inertias.select(
        F.col("cluster").alias("__cluster"), "cluster_inertia", F.get(digests, F.col("cluster")).alias("centroid_sha256")
    )
    total = inertias.select(wide("cluster_inertia")).scalar()
    # One row a cluster.
    return assigned.join(F.broadcast(by_cluster), F.col("cluster") == F.col("__cluster")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256"
    )
