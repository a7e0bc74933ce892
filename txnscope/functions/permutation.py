"""A keyed permutation of 0 .. n-1 in integer arithmetic: a shuffle without a sort.

A position is written as (left, right) with right below b, left below a, and
a * b the least such product of about sqrt(n) each that holds n.  Rounds add a
keyed function of one half to the other, modulo its range (a Feistel network on
mixed radices), so each is a bijection; a result of n or more is permuted
again until it is below n (cycle walking).  At most b - 1 values lie beyond n,
so ``WALKS`` repetitions are all but never used up; a row that would need more
raises instead of being placed wrongly.

The key function is (x + k1)^2 * k2 + k3 modulo 2^31 - 1, so every number stays
in a long and another engine's integers give the same order.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
ROUNDS, WALKS = 6, 24


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three numbers below PRIME, the second above zero, for each round."""
    out = []
    for r in range(rounds):
        h = hashlib.sha256(f"{seed}:{r}".encode()).digest()
        k = [int.from_bytes(h[i:i + 8], "big") for i in (0, 8, 16)]
        out.append((k[0] % PRIME, 1 + k[1] % (PRIME - 1), k[2] % PRIME))
    return out


def radices(n: int) -> tuple[int, int]:
    """a, b with a * b >= n, both about the root of n."""
    b = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return max(1, -(-n // b)), b


def permuted(x: int, n: int, seed: int) -> int:
    """The same permutation of one Python number."""
    a, b = radices(n)
    while True:
        left, right = x // b, x % b
        for r, (k1, k2, k3) in enumerate(round_keys(seed)):
            v = right if r % 2 == 0 else left
            y = ((v + k1) % PRIME) ** 2 % PRIME * k2 % PRIME + k3
            left, right = ((left + y) % a, right) if r % 2 == 0 else (left, (right + y) % b)
        x = left * b + right
        if x < n:
            return x


def _once(x: Column, a: int, b: int, seed: int) -> Column:
    start = F.struct(F.call_function("div", x, F.lit(b)).cast("bigint").alias("l"), (x % b).cast("bigint").alias("r"))
    keys = F.array(*[F.struct(F.lit(r % 2).alias("side"), *[F.lit(k).cast("bigint").alias(f"k{i}") for i, k in enumerate(ks)])
                     for r, ks in enumerate(round_keys(seed))])

    def step(s: Column, k: Column) -> Column:
        v = F.when(k["side"] == 0, s["r"]).otherwise(s["l"])
        t = (v + k["k0"]) % PRIME
        y = ((t * t) % PRIME * k["k1"]) % PRIME + k["k2"]
        return F.struct(F.when(k["side"] == 0, (s["l"] + y) % a).otherwise(s["l"]).alias("l"),
                        F.when(k["side"] == 0, s["r"]).otherwise((s["r"] + y) % b).alias("r"))
    return F.aggregate(keys, start, step, lambda s: s["l"] * b + s["r"])


def keyed_position(x: Column, n: int, seed: int = 42) -> Column:
    """Place of position ``x`` (0 .. n-1) after the shuffle; null for any other number."""
    a, b = radices(n)
    x = x.cast("bigint")
    inside = (x >= 0) & (x < n)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), _once(x, a, b, seed),
                         lambda s, _: F.when(s >= n, _once(s, a, b, seed)).otherwise(s))
    done = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("the permutation needs more walks")).cast("bigint"))
    return F.when(inside, done)


def permutation_sql(table: str, position: str, n: str, seed: int = 42, walks: int = WALKS) -> str:
    """A query of ``table`` that adds ``place``; ``position`` and ``n`` are SQL expressions over it (n a scalar subquery)."""
    def once(inner: str, start: bool) -> str:
        cols = "* EXCLUDE (l, r)" if not start else "*"
        q = f"SELECT {cols}, x // b AS l, x % b AS r FROM ({inner})"
        for r, (k1, k2, k3) in enumerate(round_keys(seed)):
            v = "r" if r % 2 == 0 else "l"
            y = f"((((({v} + {k1}) % {PRIME}) * (({v} + {k1}) % {PRIME})) % {PRIME}) * {k2}) % {PRIME} + {k3}"
            new = f"(l + {y}) % a AS l, r" if r % 2 == 0 else f"l, (r + {y}) % b AS r"
            q = f"SELECT * EXCLUDE (l, r), {new} FROM ({q})"
        return f"SELECT * REPLACE (CASE WHEN x >= n OR fresh THEN l * b + r ELSE x END AS x, false AS fresh) FROM ({q})"
    q = (f"SELECT *, CAST(ceil(n / CAST(b AS DOUBLE)) AS BIGINT) AS a FROM (SELECT *, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS b "
         f"FROM (SELECT *, CAST({position} AS BIGINT) AS x, CAST({n} AS BIGINT) AS n, true AS fresh FROM {table}))")
    for i in range(walks):
        q = once(q, i == 0)
    return f"SELECT * EXCLUDE (x, n, b, a, fresh, l, r), x AS place FROM ({q})"


def row_positions(df: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """``df`` with ``position`` (0 .. n-1 by id) and n.  Ids are unique and not null.

    Ids without gaps are their own positions less the smallest; others are ranked in range parts, each part by
    itself, behind the sizes of the parts before it."""
    from pyspark.sql import Window

    from txnscope.session import materialize
    about = df.agg(F.count("*").alias("n"), F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).first()
    n = about["n"]
    whole = dict(df.dtypes)[id_col] in ("int", "bigint", "smallint", "tinyint")
    if not n or (whole and about["hi"] - about["lo"] + 1 == n):
        return df.withColumn("position", F.col(id_col).cast("bigint") - F.lit(about["lo"]).cast("bigint")
                             if n else F.lit(None).cast("bigint")), n
    parts = max(1, -(-n // (1 << 20)))
    ranged = materialize(df.repartitionByRange(parts, id_col).withColumn("__part", F.spark_partition_id()), "position-parts")
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))              # one row for about a million
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(id_col))
    return ranged.withColumn("__rank", rank).join(offsets, "__part") \
        .withColumn("position", F.col("__before") + F.col("__rank") - 1).drop("__part", "__rank", "__before"), n


def shuffled_positions(df: DataFrame, id_col: str = "txn_id", seed: int = 42) -> DataFrame:
    """P7: ``df`` with ``place``, its row's place in a keyed shuffle of all rows; no row is moved."""
    rows, n = row_positions(df, id_col)
    return rows.withColumn("place", keyed_position(F.col("position"), n, seed)).drop("position")


def first_n_shuffled(df: DataFrame, n: int, id_col: str = "txn_id", seed: int = 42) -> DataFrame:
    """W9: the ``n`` rows that come first in that shuffle, by a filter."""
    rows, total = row_positions(df, id_col)
    return rows.where(keyed_position(F.col("position"), total, seed) < n).drop("position")
