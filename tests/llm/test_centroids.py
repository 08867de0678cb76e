from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import centroids as C

ROWS = "vec_id long, embedding array<float>, cluster string, id int"


def vectors(n: int, dims: int, seed: int = 5) -> list[tuple]:
    draw = random.Random(seed)
    middles = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [float(np.float32(m + draw.gauss(0, 0.2))) for m in middles[i % 6]]) for i in range(n)]
    rows += [(i, rows[0][1]) for i in (n, n + 1, 3, 3)]  # ties, repeated ids and rows
    return rows


def plain(rows: list[tuple], dims: int, clusters: int, rounds: int) -> list[tuple]:
    points = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest()
    now = [v for _, _, v in sorted((name(i), j, v) for j, (i, v) in enumerate(sorted(points, key=lambda p: p[1])))][:clusters]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((far(v, c), j) for j, c in enumerate(now)) for _, v in points]
    for _ in range(rounds):
        of = [j for _, j in assign()]
        for j in set(of):
            own = [v for (_, v), k in zip(points, of, strict=True) if k == j]
            now[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = assign()
    total = [sum(d for d, j in last if j == k) for k in range(len(now))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return [(i, j, d, total[j], sum(total), digest[j]) for (i, _), (d, j) in zip(points, last, strict=True)]


@pytest.mark.parametrize("dims,clusters,rounds", [(64, 8, 10), (5, 3, 2), (20, 40, 4)])
def test_against_plain_loops(spark, dims, clusters, rounds):
    rows = vectors(150, dims) + [(900, None), (901, []), (902, [1.0]), (903, [math.nan] * dims), (904, [math.inf] * dims), (905, [None] * dims)]
    rows += [(None, [0.5] * dims), (906, [0.0] * dims), (907, [-0.0001] * dims)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(3)
    got = C.centroid_clusters(table, dims=dims, clusters=clusters, rounds=rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows, dims, clusters, rounds), key=str)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)
    assert sorted(map(tuple, C.centroid_clusters(table, dims=2).collect())) == sorted(plain(rows, 2, 8, 10))
    assert C.centroid_clusters(table, dims=3).collect() == []
    assert C.centroid_clusters(table.limit(0), dims=2).columns[-1] == "centroid_sha256"
    with pytest.raises(Exception, match="is beyond"):
        C.centroid_clusters(table.withColumn("embedding", F.array(F.lit(1e30), F.lit(0.0))), dims=2).collect()


def test_bounds_spare_distances_and_never_err():
    draw = np.random.default_rng(3)
    middles = draw.normal(0, 900, (50, 64))
    for scale in (1, 1000):
        ints = np.floor(middles[draw.integers(0, 50, 4000)] + draw.normal(0, 60, (4000, 64))).astype(np.int64) * scale
        mean, (_, axes) = ints.mean(0), np.linalg.eigh(np.cov(ints.T))
        axes = axes[:, ::-1]
        chosen = np.floor(middles).astype(np.int64) * scale
        chosen[7] = chosen[3]  # a tie everywhere
        label, best, taken = C.nearest(ints, *C.rotated(ints, mean, axes, 16), chosen, *C.rotated(chosen, mean, axes, 16))
        exact = ((ints[:, None, :] - chosen[None]) ** 2).sum(2)
        assert (label == exact.argmin(1)).all() and (best == exact.min(1)).all()
        assert taken < 4000 * 50 / 4
