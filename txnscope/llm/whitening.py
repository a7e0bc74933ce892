"""Embedding whitening by a bit-sliced scatter matrix.

A block of vectors is turned into integers, shifted by the block's least
value of each dimension, and cut into bit planes; a plane of 64 rows is one
word.  The cross-product of two dimensions is then the sum over their planes
p, q of 2^(p+q) * popcount(plane_p AND plane_q): exact at any number of rows.
Blocks send these sums (one row for each pair of dimensions) to Spark's
partial aggregation, so the shuffle holds a fixed number of rows for a block
and nothing grows at the driver but with the dimensions.  The scatter is
centred as integers (n * P - S S') before it becomes floating point, and its
eigenvectors give the components.

Edge cases: rows whose vector is null, or has null or non-finite entries, or
another length than the commonest, take no part; repeated rows count as often
as they occur and null ids are kept; a component without variance (constant or
dependent dimensions, fewer rows than components) has a null ``whitened``; an
exact ``deviation`` above 2^63 - 1 is null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.vectors import blocks, limbs, matrix, scaled, usable, whole

#: Eigenvalues below this share of the largest count as zero.
RANK = 1e-12
SUMS = "i int, j int, a bigint, b bigint, c bigint"


@dataclass(frozen=True)
class Whitening:
    """n rows with per-dimension sums; unit ``components`` (dims, k) and ``eigenvalues`` by falling eigenvalue."""
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    scale: int
    shift: int

    @property
    def divisors(self) -> np.ndarray:
        """Square roots of the eigenvalues, NaN for a component without variance."""
        e = self.eigenvalues
        return np.sqrt(np.where(e > RANK * max(e[0], 0.0), e, np.nan)) if len(e) else e


def plane_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cross-products, sums) of the columns of ``y`` (rows, dims), unsigned, as exact Python integers."""
    rows, dims = y.shape
    width = max(1, int(y.max()).bit_length())
    planes = np.zeros((dims, width, -(-rows // 64) * 8), np.uint8)
    for p in range(width):
        bits = np.packbits(((y.T >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), axis=1)
        planes[:, p, :bits.shape[1]] = bits
    flat = planes.reshape(dims * width, -1).view(np.uint64)
    counts = np.zeros((dims * width, dims * width), np.int64)
    for a in range(len(flat)):
        counts[a, a:] = np.bitwise_count(flat[a] & flat[a:]).sum(axis=1, dtype=np.int64)
    both = np.triu(counts) + np.triu(counts, 1).T
    small = 2 * width + rows.bit_length() < 62
    weight = np.array([2 ** p for p in range(width)], np.int64 if small else object)
    grid = both.reshape(dims, width, dims, width)
    if not small:
        grid = grid.astype(object)
    products = np.tensordot(np.tensordot(grid, weight, (3, 0)), weight, (1, 0))
    sums = np.diagonal(both).reshape(dims, width).astype(object) @ np.array([2 ** p for p in range(width)], object)
    return products.astype(object), sums


def block_sums(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, sum of x_i * x_j) for i <= j, (i, -1, sum of x_i) and (-1, -1, rows) of one block."""
    low = x.min(axis=0)
    products, sums = plane_products((x - low).view(np.uint64))
    n, dims, low = len(x), x.shape[1], low.astype(object)
    moved = products + np.multiply.outer(low, sums) + np.multiply.outer(sums, low) + n * np.multiply.outer(low, low)
    yield -1, -1, n
    for i in range(dims):
        yield i, -1, sums[i] + n * low[i]
        for j in range(i, dims):
            yield i, j, moved[i, j]


def fit(rows: DataFrame, dims: int, scale: int = 64, shift: int = 1_000_000, k: int = 32,
        block_rows: int = 1 << 16) -> Whitening | None:
    """The whitening of all vectors in ``rows`` (column vec, ``dims`` entries); None without rows."""
    if not dims:
        return None
    size = max(64, min(block_rows, (1 << 22) // dims))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in blocks(batches, dims, size):
            found = [(i, j, *limbs(int(v))) for i, j, v in block_sums(scaled(x, scale, shift))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if at < 2 else pa.int64()) for at, c in enumerate(zip(*found, strict=True))],
                names=["i", "j", "a", "b", "c"])

    sums = {(r.i, r.j): whole(r.a, r.b, r.c) for r in rows.select("vec").mapInArrow(scatter, SUMS).groupBy("i", "j")
            .agg(*[F.sum(c).alias(c) for c in "abc"]).collect()}
    if not sums:
        return None
    n, s = sums[-1, -1], [sums[i, -1] for i in range(dims)]
    v = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * sums[i, j] - s[i] * s[j]) / (n * n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = np.maximum(values[::-1][:k], 0.0), vectors[:, ::-1][:, :k]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[top, np.arange(len(top))])          # one sign for all rows
    return Whitening(n, s, vectors, values, float(np.trace(v)), scale, shift)


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S, exact: long where it fits, else Python integers."""
    middle = [round(t / model.n) for t in model.sums]
    rest = [t - model.n * m for t, m in zip(model.sums, middle, strict=True)]
    if model.n * float(np.abs(x - np.array(middle, float)).max(initial=0)) < 2 ** 61:
        return model.n * (x - np.array(middle, np.int64)) - np.array(rest, np.int64)
    return model.n * x.astype(object) - np.array(model.sums, object)


def projected(d: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened coordinates of centred rows."""
    return (d / model.n).astype(np.float64) @ (model.components / model.divisors)


def deviations(d: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row, null where it is no long."""
    if d.dtype != object and len(d) and float(np.abs(d).max()) ** 2 * d.shape[1] < 2 ** 62:
        return (d * d).sum(axis=1).tolist()
    exact = (d.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 2 ** 63 else None for v in exact]


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of all whitened rows minus the identity; null without components.

    The rows are centred exactly before they are projected, so their sums are rounding noise and taken off as well."""
    dims, live = len(model.sums), np.flatnonzero(~np.isnan(model.divisors))
    if not len(live):
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((len(live), len(live))), np.zeros(len(live))
        for batch in batches:
            d = centred(scaled(matrix(batch.column("vec"), dims), model.scale, model.shift), model)
            z = projected(d, model)[:, live]
            total, sums = total + z.T @ z, sums + z.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[i.ravel(), np.arange(len(live))], pa.int32()),
             pa.array(np.r_[j.ravel(), np.full(len(live), -1)], pa.int32()),
             pa.array(np.r_[total.ravel(), sums])], names=["i", "j", "v"])

    found = {(r.i, r.j): r.v for r in rows.select("vec").mapInArrow(products, "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    m = np.array([found[i, -1] for i in range(len(live))]) / model.n
    c = np.array([[found[i, j] for j in range(len(live))] for i in range(len(live))]) / model.n - np.outer(m, m)
    return float(np.abs(c - np.eye(len(live))).max())


def whiten(df: DataFrame, key: str = "vec_id", vec: str = "embedding", scale: int = 64, shift: int = 1_000_000,
           k: int = 32) -> DataFrame:
    """One row for each usable vector and component: key, component, n, deviation, whitened, explained and
    identity_error."""
    kind = df.select(key).schema[0].dataType.simpleString()
    schema = (f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    rows, dims = usable(df, key, vec)
    model = fit(rows, dims, scale, shift, k)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error, parts = identity_error(rows, model), len(model.eigenvalues)
    share = model.eigenvalues / model.trace if model.trace > 0 else np.full(parts, np.nan)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = centred(scaled(matrix(batch.column("vec"), dims), scale, shift), model)
            at = pa.array(np.repeat(np.arange(len(d)), parts))
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(at), pa.array(np.tile(np.arange(1, parts + 1), len(d)), pa.int32()),
                pa.array(np.full(len(d) * parts, model.n)), pa.array(deviations(d), pa.int64()).take(at),
                pa.array(projected(d, model).ravel(), from_pandas=True),
                pa.array(np.tile(share, len(d)), from_pandas=True), pa.array([error] * (len(d) * parts), pa.float64())],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(apply, schema)
