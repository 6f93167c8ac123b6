from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from farekit.llm import centroids, queries
from tests import oracle
from tests.llm.cases import crowded

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=8, rounds=10, dimensions=64):
    """Plain rounds over Python integers: (vec_id, cluster, distance, cluster_inertia, inertia, digest) of every kept row."""
    kept = [
        (i, [math.floor(1024 * float(v)) for v in x]) for i, x in rows
        if x is not None and len(x) == dimensions and all(v is not None and math.isfinite(v) for v in x)
    ]
    digest = lambda i: (i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "")
    places = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    nearest = lambda x: min((square(x, c), j) for j, c in enumerate(places))
    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        places = [[sum(v) // len(groups[j]) for v in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(places)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for _, j, _ in found}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in found), key=str)


def rows_of(df):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def blobs(n, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 64))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 64)) * spread
    return [(i, [float(v) for v in np.float32(row)]) for i, row in enumerate(x)]


def test_loosening_bounds_every_point_of_the_sphere():
    rng = np.random.default_rng(5)
    less = 0
    for _ in range(2000):
        d = int(rng.integers(2, 6))
        old, centre = rng.normal(size=(2, d)) * 3
        new = old + rng.normal(size=d) * rng.choice([0.01, 0.5, 4])
        radius = float(rng.choice([0.0, 0.3, 2.0, 8.0]))
        direction = rng.normal(size=(200, d))
        points = centre + direction / np.linalg.norm(direction, axis=1)[:, None] * radius * rng.random((200, 1)) ** 0.3
        # The ends of the sphere along and across the drift are where the most is to be lost.
        line = (new - old) / np.linalg.norm(new - old)
        points = np.vstack([points, centre + line * radius, centre - line * radius])
        nearer = np.linalg.norm(points - old, axis=1) - np.linalg.norm(points - new, axis=1)
        bound = centroids.loosening(old, new, centre, radius)
        drift = np.linalg.norm(new - old)
        assert nearer.max() <= bound + 1e-9 and bound <= drift + 1e-9
        less += bound < 0.9 * drift
    assert less > 800
    assert centroids.loosening(old, old, centre, 1.0) == 0.0


def test_settle_equals_a_full_scan_over_random_moves():
    rng = np.random.default_rng(6)
    x = rng.integers(-60, 60, (3000, 3))
    places = x[:6].tolist()
    move, state, scans = centroids.Move.start(places), None, []
    for _ in range(12):
        *state, scanned = centroids.settle(x, move, state)
        scans.append(scanned)
        every = ((x[:, None, :] - np.array(move.centroids)[None]) ** 2).sum(2)
        assert (state[0] == every.argmin(1)).all()
        assert (state[1] >= np.sqrt(every.min(1))).all()
        assert (state[2] <= np.sqrt(np.sort(every, 1)[:, 1])).all()
        radius = [float(state[1][state[0] == c].max()) if (state[0] == c).any() else 0.0 for c in range(6)]
        new = [(np.array(p) + rng.integers(-4, 5, 3)).tolist() for p in move.centroids]
        move = centroids.Move.between(move.centroids, new, radius)
    assert scans[0] == 3000 and sum(scans[1:]) < 11 * 3000


def test_clusters_equal_brute_force(spark):
    rows = blobs(700)
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).repartition(5)
    assert rows_of(centroids.clustered(df)) == brute(rows)


def test_geometry_scans_less_than_full_drift(spark):
    df = spark.createDataFrame([(i, x, 0) for i, x in blobs(3000, spread=0.8)], SCHEMA)
    tight, loose = centroids.fit(df), centroids.fit(df, tight=False)
    assert tight.move.centroids == loose.move.centroids
    assert sum(tight.scanned[1:]) < sum(loose.scanned[1:]) < 9 * 3000


def test_a_round_moves_no_vector_between_tasks(spark):
    df = spark.createDataFrame([(i, x, 0) for i, x in blobs(300)], SCHEMA)
    found = centroids.fit(df, rounds=2)
    plan = centroids._joined(found.blocks, found.state)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


ODD = [
    *blobs(30, seed=3), (0, blobs(1, seed=3)[0][1]), (7, None), (8, []), (9, [0.5] * 63), (10, [0.5] * 65),
    (11, [None] + [0.5] * 63), (12, [math.nan] + [0.5] * 63), (13, [math.inf] + [0.5] * 63), (None, [0.25] * 64),
    (None, [0.25] * 64), (14, [-0.0] * 64), (14, [1e6] * 64), (2**62, [-0.0004] * 64),
]


@pytest.mark.parametrize("rows", [ODD, ODD[:3], ODD[30:32], [(5, [0.1] * 64)] * 9])
def test_odd_rows(spark, rows):
    df = crowded(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA), "x", "block", "cluster", "distance")
    assert rows_of(centroids.clustered(df)) == brute(rows)


def test_vectors_too_long_for_64_bits_do_not_crash(spark):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64), (4, [2e9] * 64)]
    found = centroids.clustered(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA), clusters=2, rounds=2)
    assert found.count() == 4 and found.agg({"distance": "min"}).first()[0] >= 0


def test_empty_table_gives_no_row(spark):
    found = centroids.clustered(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and "centroid_sha256" in found.columns
    assert centroids.clustered(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0


def test_query_agrees_with_sql_and_brute_force(spark, data_dir):
    df = queries.QUERIES["op12_centroid_clusters"](spark, data_dir)
    assert oracle.compare(df, oracle.connect(data_dir), queries.ORACLES["op12_centroid_clusters"]) == []
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").collect()]
    assert rows_of(df) == brute(rows)
