"""Centroid clustering by a tournament of bisecting planes.

For centroids a < b the nearer one is told by the sign of N.x - T with the
integer normal N = 2 (b - a) and threshold T = |b|^2 - |a|^2: zero or less
means a, so a tie goes to the smaller number.  k - 1 such tests leave one
winner for each vector; only its distance is computed, exactly.  A round needs
one pass over the vectors: tasks sum the components of each cluster, Spark
adds these partial sums (k * dims rows a task) and the driver holds nothing
but the centroids, whose number does not grow.

Edge cases: vectors that are null, have another number of components than
asked for, or hold null or non-finite ones, take no part; repeated rows count
as often as they occur; a null id is written as the empty text when seeds are
drawn; seeds with equal hashes go by their components; with fewer vectors than
centroids there are fewer centroids; distances and inertias above 2^63 - 1 are
null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.vectors import limbs, matrix, scaled, usable, whole
from txnscope.session import materialize

#: Below this size of components all tests fit into longs (up to 512 dimensions).
SMALL = 1 << 26


def exact(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """``x`` as longs if no test can leave them, else as Python integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    return x if most < SMALL and x.shape[1] <= 512 else x.astype(object)


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals (k, k, dims) and thresholds (k, k) of all pairs; entry [a, b] is used for a < b."""
    square = (centroids * centroids).sum(axis=1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), square[None, :] - square[:, None]


def winners(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each row by k - 1 sign tests."""
    normals, thresholds = bisectors(centroids)
    best = np.zeros(len(x), np.int64)
    for b in range(1, len(centroids)):
        for a in np.unique(best):
            rows = np.flatnonzero(best == a)
            best[rows[(x[rows] @ normals[a, b] - thresholds[a, b]) > 0]] = b
    return best


def distances(x: np.ndarray, centroids: np.ndarray, best: np.ndarray) -> np.ndarray:
    gap = x - centroids[best]
    return (gap * gap).sum(axis=1)


def _assigner(centroids: list[list[int]], dims: int, scale: int):
    def assign(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = scaled(matrix(batch.column("vec"), dims), scale)
        c = np.array(centroids, object)
        x = exact(x, c)
        c = c.astype(x.dtype)
        best = winners(x, c)
        return x, best, distances(x, c, best)
    return assign


def next_centroids(rows: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """Componentwise floor of each cluster's mean; empty clusters keep their centroid."""
    assign, k = _assigner(centroids, dims, scale), len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for batch in batches:
            x, best, _ = assign(batch)
            for c in np.unique(best):
                # Python integers behind the halves: one batch of longs cannot overflow in them.
                own = x[best == c]
                total[c] += (own >> 32).sum(axis=0).astype(object) * 2 ** 32 + (own & 0xffffffff).sum(axis=0).astype(object)
                counts[c] += len(own)
        made = [(c, i, counts[c], *limbs(int(total[c, i]))) for c in range(k) if counts[c] for i in range(dims)]
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int32() if at < 2 else pa.int64()) for at, v in enumerate(zip(*made, strict=True))],
                names=["cluster", "i", "n", "a", "b", "c"])

    found = rows.select("vec").mapInArrow(sums, "cluster int, i int, n bigint, a bigint, b bigint, c bigint") \
        .groupBy("cluster", "i").agg(*[F.sum(v).alias(v) for v in "nabc"]).collect()
    out = [list(c) for c in centroids]
    for r in found:
        out[r.cluster][r.i] = whole(r.a, r.b, r.c) // r.n
    return out


def seeds(rows: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``seed:key``, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    drawn = rows.select(mark.alias("mark"), "vec").orderBy("mark", "vec").limit(k).collect()
    return [scaled(np.array(r.vec, np.float64), scale).tolist() for r in drawn]


def centroid_text(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(df: DataFrame, key: str = "vec_id", vec: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3,
            scale: int = 64, seed: int = 1) -> DataFrame:
    """For each usable vector: key, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    spark = df.sparkSession
    kind = df.select(key).schema[0].dataType.simpleString()
    rows, _ = usable(df, key, vec, dims)
    centroids = seeds(rows, k, scale, seed)
    if not centroids:
        return spark.createDataFrame([], f"`{key}` {kind}, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids, dims, scale)
    assign = _assigner(centroids, dims, scale)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, far = assign(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(best, pa.int32()),
                 pa.array([v if v < 2 ** 63 else None for v in far.tolist()], pa.int64())],
                names=["key", "cluster", "distance"])

    found = materialize(rows.mapInArrow(label, f"key {kind}, cluster int, distance bigint"), "clusters")
    # At most k rows; a sum that meets a null distance, or is no long, is null.
    sums = {r.cluster: None if r.gone else int(r.total) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"),
        F.count_if(F.col("distance").isNull()).alias("gone")).collect()}
    fits = lambda v: v if v is not None and v < 2 ** 63 else None                            # noqa: E731
    every = None if None in sums.values() else sum(sums.values())
    named = spark.createDataFrame(
        [(c, fits(sums.get(c, 0)), fits(every), centroid_text(v)) for c, v in enumerate(centroids)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64, seed: int = 1) -> str:
    """The same rows of ``embeddings`` in DuckDB, by comparing every distance."""
    def nearest(at: int) -> str:
        return f"""a{at} AS (SELECT vec_id, x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
          SELECT v.rid, v.vec_id, v.x, m.c, list_sum(list_transform(list_zip(v.x, m.m),
            lambda z: ((z[1] - z[2]) * (z[1] - z[2]))::HUGEINT)) AS d FROM v, m{at} m) GROUP BY rid, vec_id, x)"""

    def moved(at: int) -> str:
        return f"""s{at} AS (SELECT c, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS n
          FROM a{at}, range(1, {dims + 1}) r(i) GROUP BY c, i),
        m{at + 1} AS (SELECT m.c, coalesce(n.m, m.m) AS m FROM m{at} m LEFT JOIN (
          SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{at} GROUP BY c) n ON m.c = n.c)"""

    steps = ",\n".join(f"{nearest(at)},\n{moved(at)}" for at in range(rounds))
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
          list_transform(embedding, lambda e: floor({scale} * e::DOUBLE)::BIGINT) AS x FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) = {dims}
            AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims}),
        m0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x AS m FROM (
          SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {k})),
        {steps},
        {nearest(rounds)}
        SELECT a.vec_id, a.c::INTEGER AS "cluster", a.d::BIGINT AS distance,
          (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
          sha256(array_to_string(m.m, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN m{rounds} m ON a.c = m.c"""
