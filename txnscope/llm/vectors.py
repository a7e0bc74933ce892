"""What the vector operators share: which rows take part, and Arrow batches as numpy blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(col: str) -> Column:
    """True where the vector is present and every entry is a finite number."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(F.col(col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                               & (F.abs(x.cast("double")) != inf)), F.lit(False))


def usable(df: DataFrame, key: str, vec: str, dims: int | None = None) -> tuple[DataFrame, int]:
    """Rows (key, vec) of finite vectors with ``dims`` entries, and ``dims``.

    Without ``dims`` it is the commonest length above zero (of equally common ones the longest); 0 without vectors."""
    rows = df.select(F.col(key).alias("key"), F.col(vec).alias("vec")).where(finite("vec"))
    if dims is None:
        top = rows.where(F.size("vec") > 0).groupBy(F.size("vec").alias("d")).count() \
            .orderBy(F.desc("count"), F.desc("d")).first()
        dims = top["d"] if top else 0
    return rows.where((F.size("vec") == dims) & (F.size("vec") > 0)), dims


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column without nulls as a (rows, dims) array of its own number type."""
    return np.asarray(column.flatten()).reshape(-1, dims)


def blocks(batches: Iterator[pa.RecordBatch], dims: int, rows: int) -> Iterator[np.ndarray]:
    """The ``vec`` column of all batches in blocks of up to ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        x = matrix(batch.column("vec"), dims)
        while len(x):
            held.append(x[:rows - n])
            n += len(held[-1])
            x = x[len(held[-1]):]
            if n == rows:
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def scaled(x: np.ndarray, scale: int, shift: int = 0) -> np.ndarray:
    """floor(scale * x) + shift as long, x as double; numbers beyond 2^62 count as 2^62 of their sign."""
    return np.clip(np.floor(scale * x.astype(np.float64)), -2.0 ** 62, 2.0 ** 62).astype(np.int64) + shift


def limbs(v: int) -> tuple[int, int, int]:
    """v = a * 2^80 + b * 2^40 + c with small parts, so that Spark's long sums of many parts stay exact."""
    return v >> 80, (v >> 40) & (2 ** 40 - 1), v & (2 ** 40 - 1)


def whole(a: int, b: int, c: int) -> int:
    """The number whose limbs, or sums of them, are given."""
    return (a << 80) + (b << 40) + c
