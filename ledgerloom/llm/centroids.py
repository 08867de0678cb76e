"""Centroid clustering in integers, with a rotated table that spares most exact distances.

Vectors become integers, and one pass over all of them gives their covariance. Its main axes
rotate every vector; the leading coordinates and the norm of what is left are stored beside
the integers. The distance of the leading coordinates plus the squared difference of the two
rest norms is never above the true squared distance. So a vector looks at centroids in the
order of that bound, takes exact distances in integers, and stops where the bound passes the
best of them. Sums of a round are one array a task; the driver sees clusters times
components of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import stored

#: So many rotated coordinates are stored.
LEADING = 16


def most_component(dims: int) -> int:
    """Integer components up to this size have squared distances that fit into 63 bits."""
    return math.isqrt((1 << 61) // dims)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, ints`` of the vectors with ``dims`` components, all finite: ``floor(scale * x)`` of each.

    Raises where a component is beyond :func:`most_component`, as no long holds the distances.
    """
    most = most_component(dims)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * F.lit(float(scale)))
        large = F.raise_error(F.lit(f"a component times {scale} is beyond {most}"))
        return F.when(F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float(most)), scaled.cast("int")).otherwise(large.cast("int"))

    vector = F.col(vector_col)
    kept = vectors.select(F.col(id_col).alias("id"), vector.alias("v")).where(F.size("v") == dims).where(F.forall("v", finite))
    return kept.select("id", F.transform("v", whole).alias("ints"))


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _added_up(totals: DataFrame) -> dict[int, float]:
    """Sums of ``slot, value`` rows of all tasks; there are as many slots as the caller's model has numbers."""
    return {r["slot"]: r["value"] for r in totals.groupBy("slot").agg(F.sum("value").alias("value")).collect()}


def _slots(values: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    flat = values.ravel()
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat, kind)], names=["slot", "value"])


def main_axes(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of all vectors and the axes of their covariance, the widest first, as columns."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            rows = _matrix(batch.column("ints"), dims, np.float64)
            rows = np.hstack([rows, np.ones((len(rows), 1))])
            total += rows.T @ rows
        yield _slots(total, pa.float64())

    found = _added_up(vectors.select("ints").mapInArrow(moments, "slot int, value double"))
    total = np.array([found.get(i, 0.0) for i in range((dims + 1) ** 2)]).reshape(dims + 1, dims + 1)
    count = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / count
    spread, axes = np.linalg.eigh(total[:-1, :-1] / count - np.outer(mean, mean))
    return mean, axes[:, np.argsort(-spread, kind="stable")]


def rotated(ints: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the others, in single precision."""
    turned = (ints - mean) @ axes
    rest = np.sqrt(np.einsum("ij,ij->i", turned[:, leading:], turned[:, leading:]))
    return turned[:, :leading].astype(np.float32), rest.astype(np.float32)


def nearest(
    ints: np.ndarray, leading: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_leading: np.ndarray, c_rest: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and how many distances were taken.

    Of equally near centroids the smaller number wins. The bounds are lowered by more than
    single precision can err.
    """
    rows, many = len(ints), len(centroids)
    leading, rest = leading.astype(np.float64), rest.astype(np.float64)
    c_leading, c_rest = c_leading.astype(np.float64), c_rest.astype(np.float64)
    norms = np.sqrt((leading * leading).sum(1) + rest * rest)
    c_norms = np.sqrt((c_leading * c_leading).sum(1) + c_rest * c_rest)
    bounds = np.empty((rows, many))
    for j in range(many):
        apart = leading - c_leading[j]
        gap = np.sqrt((apart * apart).sum(1) + (rest - c_rest[j]) ** 2)
        bounds[:, j] = np.maximum(gap - 1e-6 * (norms + c_norms[j]) - 1e-3, 0.0) ** 2
    order = np.argsort(bounds, axis=1, kind="stable")
    best, label = np.full(rows, np.iinfo(np.int64).max), np.full(rows, many, np.int64)
    alive, taken = np.arange(rows), 0
    for place in range(many):
        j = order[alive, place]
        near = bounds[alive, j] <= best[alive]  # bounds ascend: what is out stays out
        alive, j = alive[near], j[near]
        if not len(alive):
            break
        apart = ints[alive] - centroids[j]
        distance = np.einsum("ij,ij->i", apart, apart)
        taken += len(alive)
        better = (distance < best[alive]) | ((distance == best[alive]) & (j < label[alive]))
        best[alive[better]], label[alive[better]] = distance[better], j[better]
    return label, best, taken


def _first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    chosen = vectors.select(F.sha2(name, 256).alias("hash"), "ints").orderBy("hash", "ints").limit(clusters).collect()
    return np.array([r["ints"] for r in chosen], np.int64)


def centroid_clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    scale: int = 1024,
    clusters: int = 8,
    rounds: int = 10,
    seed: int = 3,
) -> DataFrame:
    """``vec_id`` (or ``id_col``), ``cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every whole vector.

    Vectors of another length, null ones and ones with null or non-finite components are left
    out. Every row is a vector, also one with a null id (hashed as ``null``) or one that
    repeats another; where ids and so their hashes tie, the smaller integers come first. With
    fewer vectors than ``clusters`` each is a centroid; an empty table gives no rows. Other
    columns do not matter. Rounds end early when no centroid moved, as all later ones would
    repeat the last. Centroids travel in closures: ``clusters * dims`` numbers.
    """
    whole = whole_vectors(vectors, id_col, vector_col, dims, scale)
    kind = whole.schema["id"].dataType.simpleString()
    leading = min(LEADING, dims)
    mean, axes = main_axes(whole, dims)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, rest = rotated(_matrix(batch.column("ints"), dims, np.float64), mean, axes, leading)
            places = pa.array(np.arange(len(first) + 1, dtype=np.int32) * leading)
            columns = [*batch.columns, pa.ListArray.from_arrays(places, pa.array(first.ravel())), pa.array(rest)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ints", "leading", "rest"])

    table = stored(whole.mapInArrow(turned, f"id {kind}, ints array<int>, leading array<float>, rest float"), "rotated")
    centroids = _first_centroids(table, clusters, seed)
    many = len(centroids)
    output = f"id {kind}, cluster int, distance long"
    if not many:
        none = "cluster_inertia long, inertia long, centroid_sha256 string"
        return table.sparkSession.createDataFrame([], f"{output}, {none}").withColumnRenamed("id", id_col)

    def labels_of(batch: pa.RecordBatch, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ints = _matrix(batch.column("ints"), dims, np.int64)
        rest = batch.column("rest").to_numpy(zero_copy_only=False)
        label, best, _ = nearest(ints, _matrix(batch.column("leading"), leading, np.float32), rest, now, *rotated(now, mean, axes, leading))
        return ints, label, best

    for _ in range(rounds):
        now = centroids

        def sums(batches: Iterator[pa.RecordBatch], now: np.ndarray = now) -> Iterator[pa.RecordBatch]:
            total = np.zeros((many, dims + 1), np.int64)
            for batch in batches:
                ints, label, _ = labels_of(batch, now)
                for j in np.unique(label):
                    members = ints[label == j]
                    total[j, :dims] += members.sum(0)
                    total[j, dims] += len(members)
            yield _slots(total, pa.int64())

        parts = table.select("ints", "leading", "rest").mapInArrow(sums, "slot int, value long")
        found = _added_up(parts.withColumn("value", F.col("value").cast("decimal(38,0)")))
        total = [[int(found[j * (dims + 1) + d]) for d in range(dims + 1)] for j in range(many)]
        moved = [[s // row[dims] for s in row[:dims]] if row[dims] else list(old) for row, old in zip(total, centroids.tolist(), strict=True)]
        centroids = np.array(moved, np.int64)
        if (centroids == now).all():
            break

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, label, best = labels_of(batch, centroids)
            columns = [batch.column("id"), pa.array(label, pa.int32()), pa.array(best, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    placed = stored(table.mapInArrow(assigned, output), "assigned")
    of_cluster = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(j, of_cluster.get(j, 0), sum(of_cluster.values()), names[j]) for j in range(many)]
    known = table.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster
    return placed.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql(clusters: int = 8, rounds: int = 10) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} as materialized (
    select r, v, n, d from (
        select p.r, p.v, c.n, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from points p, c{i} c
    ) qualify row_number() over (partition by r order by d, n) = 1
)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} as materialized (
    select c.n, coalesce(m.v, c.v) as v from c{i} c left join (
        select n, list(((s - (((s % k) + k) % k)) // k)::bigint order by i) as v from (
            select n, i, sum(x)::bigint as s, count(*) as k
            from (select n, unnest(v) as x, unnest(range(1, 65)) as i from a{i}) group by n, i
        ) group by n
    ) m using (n)
)"""
            )
    return f"""
with points as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
    from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), c0 as materialized (
    select (row_number() over (order by sha256('3:' || coalesce(vec_id::varchar, 'null')), v) - 1)::int as n, v from points
    qualify n < {clusters}
), {", ".join(steps)}
select p.vec_id, a.n as cluster, a.d as distance, (sum(a.d) over (partition by a.n))::bigint as cluster_inertia,
    (sum(a.d) over ())::bigint as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from points p join a{rounds} a using (r) join c{rounds} c on c.n = a.n
"""


SQL = _sql()
