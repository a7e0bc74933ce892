"""SimHash near-duplicates found by the generalised pigeonhole principle.

Fingerprint: a bit is 1 if it is set in over half the 64-bit hashes of a text's
word shingles.  Texts link where fingerprints differ in at most ``max_bits``
bits; the classes are the connected components of all links.

Search works on *distinct* fingerprints, so exact copies cost one row:

1. Bit statistics of all fingerprints (bit counts and a 64 x 64 matrix of joint
   counts, summed over partitions) group correlated bits into ``n_parts`` parts.
2. A dynamic programme hands out thresholds.  If thresholds ``T_i >= -1`` fulfil
   ``sum(T_i + 1) = max_bits + 1``, two fingerprints within ``max_bits`` agree to
   within ``T_i`` bits in some part i.  It minimises the estimated number of
   candidate pairs plus probe rows; -1 leaves a part out.
3. Probe: a part with threshold T gives one key for each choice of T masked
   bits; two fingerprints within T bits in the part share one.  Fingerprints
   meet in the buckets of equal keys and are verified by counting bits.
4. A bucket of at most ``bucket_limit`` fingerprints is verified at once and
   gives a spanning forest of its links.  Larger buckets have an exact way of
   their own: each member is dealt out to all keys within ``ceil(max_bits / 2)``
   flipped bits, where those within ``max_bits`` meet; a meeting has a bounded
   number of members and rows grow linearly with the members, never as pairs.

Edge cases: null and blank texts have fingerprint 0 and are linked like any
other; equal rows share a fingerprint; rows without an id are linked but name
no class unless a class has no ids, whose name is null; an empty table gives an
empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.llm.components import components
from txnscope.session import materialize

BITS = 64


def simhash(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of one text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: only A-Z, only ASCII space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined, ends, at = b" ".join(words), [], 0
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *ends]
    h = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1:]
    hashes = np.array([h(joined[a:b - 1], 42) for a, b in zip(starts[:n], last)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 14):                     # bounded memory for very long texts
        some = hashes[i:i + (1 << 14)]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, column: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""
    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return docs.withColumn(column, fp(F.col(text).cast("string")))


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Count of fingerprints and the 64 x 64 matrix of joint bit counts, over all rows."""
    def joint(batches):
        n, m = 0, np.zeros((BITS, BITS), dtype=np.float64)
        for b in batches:
            x = np.unpackbits(b["fp"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").astype(np.float32)
            n, m = n + len(x), m + x.T @ x
        yield pd.DataFrame({"n": [n], "m": [m.ravel()]})
    parts = fps.select("fp").mapInPandas(joint, "n bigint, m array<double>")
    long = parts.select("n", F.posexplode("m").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    got = long.collect()                               # 4,096 rows whatever the input
    m = np.zeros(BITS * BITS)
    for r in got:
        m[r["i"]] = r["v"]
    return (got[0]["n"] if got else 0), m.reshape(BITS, BITS)


def correlated_parts(n: int, joint: np.ndarray, n_parts: int) -> list[list[int]]:
    """Bits in ``n_parts`` groups of near-equal width; each takes the bits most correlated with it in turn."""
    p = np.diag(joint) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = set(range(BITS)), []
    for k in range(n_parts):
        width = round(len(left) / (n_parts - k))
        seed = max(left, key=lambda b: (corr[b, list(left)].sum(), -b))
        part = [seed]
        left.discard(seed)
        while len(part) < width:
            nxt = max(left, key=lambda b: (corr[b, part].mean(), -b))
            part.append(nxt)
            left.discard(nxt)
        parts.append(sorted(part))
    return parts


def candidate_estimate(n: int, p: np.ndarray, part: list[int], same: float, t: int) -> float:
    """Estimated pairs within ``t`` bits in a part: pairs counted equal, plus those that a
    Poisson-binomial of the bits' disagreement rates puts at 1 to t."""
    dist = np.zeros(t + 2)
    dist[0] = 1.0
    for b in part:
        d = 2 * p[b] * (1 - p[b])
        dist[1:] = dist[1:] * (1 - d) + dist[:-1] * d
        dist[0] *= 1 - d
    return same + n * (n - 1) / 2 * float(dist[1:t + 1].sum())


def allocate(costs: list[list[float]], max_bits: int) -> list[int]:
    """Thresholds T_i in -1..max_bits with sum(T_i + 1) = max_bits + 1 of least total cost;
    ``costs[i][t + 1]`` is the cost of threshold t in part i."""
    need = max_bits + 1
    best: list[dict[int, tuple[float, list[int]]]] = [{0: (0.0, [])}]
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best[-1].items():
            for give in range(need - used + 1):
                c = cost + row[give]
                if used + give not in nxt or c < nxt[used + give][0]:
                    nxt[used + give] = (c, ts + [give - 1])
        best.append(nxt)
    return best[-1][need][1]


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def plan_parts(fps: DataFrame, max_bits: int, n_parts: int | None = None) -> list[tuple[list[int], int]]:
    """[(bits of a part, threshold)], from statistics of all distinct fingerprints."""
    n, joint = bit_statistics(fps)
    parts = correlated_parts(n, joint, n_parts or max_bits + 1)
    p = np.diag(joint) / max(n, 1)
    costs = []
    for part in parts:
        sizes = fps.groupBy(F.col("fp").bitwiseAND(F.lit(_mask(part))).alias("v")).agg(F.count("*").alias("c"))
        same = sizes.agg(F.sum((F.col("c") * (F.col("c") - 1) / 2).cast("double"))).first()[0] or 0.0
        costs.append([0.0] + [candidate_estimate(n, p, part, same, t) + float(n) * comb(len(part), t)
                              for t in range(max_bits + 1)])
    return list(zip(parts, allocate(costs, max_bits)))


def probe_keys(plan: list[tuple[list[int], int]]) -> Column:
    """array<struct<part, bits>>: the keys a fingerprint is found under."""
    keys = []
    for i, (part, t) in enumerate(plan):
        if t >= 0:
            for j, masked in enumerate(combinations(part, t)):
                left = [b for b in part if b not in masked]
                keys.append(F.struct(F.lit(i << 16 | j).alias("part"),
                                     F.col("fp").bitwiseAND(F.lit(_mask(left))).alias("bits")))
    return F.array(*keys)


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all fingerprints joined by distances up to ``max_bits``: a breadth-first forest."""
    x = np.sort(fps.astype(np.int64)).view(np.uint64)
    left, out = np.ones(len(x), dtype=bool), []
    for s in range(len(x)):
        if not left[s]:
            continue
        left[s], queue = False, [s]
        while queue:
            u = queue.pop()
            near = np.nonzero(left & (np.bitwise_count(x ^ x[u]) <= max_bits))[0]
            left[near] = False
            queue.extend(near.tolist())
            out += [(int(x[v].view(np.int64)), int(x[u].view(np.int64))) for v in near]
    return out


def links(fps: DataFrame, max_bits: int = 2, n_parts: int | None = None, bucket_limit: int = 256) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect exactly what all links connect."""
    plan = plan_parts(fps, max_bits, n_parts)
    keyed = fps.select("fp", F.explode(probe_keys(plan)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = materialize(keyed.join(sizes, "key"), "simhash-buckets")

    @F.pandas_udf("array<struct<a:bigint,b:bigint>>")
    def verify(groups: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in spanning_links(np.asarray(g, dtype=np.int64), max_bits)]
                          for g in groups])

    usual = met.where(F.col("n") <= bucket_limit).groupBy("key").agg(F.collect_list("fp").alias("fps")) \
        .select(F.explode(verify("fps")).alias("e")).select("e.a", "e.b")
    # Exact way for larger buckets: two fingerprints within max_bits meet at a key within half of that from both.
    reach = (max_bits + 1) // 2
    flips = [_mask(c) for k in range(reach + 1) for c in combinations(range(BITS), k)]
    hubs = met.where(F.col("n") > bucket_limit).select("fp").distinct().select(
        "fp", F.explode(F.transform(F.lit(flips), lambda m: F.col("fp").bitwiseXOR(m))).alias("hub"))
    large = hubs.groupBy("hub").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1) \
        .select(F.explode(verify("fps")).alias("e")).select("e.a", "e.b")
    return usual.unionByName(large).distinct()


def near_duplicates(rows: DataFrame, max_bits: int = 2, n_parts: int | None = None,
                    bucket_limit: int = 256) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of ``rows`` (doc_id, fp): the class as a
    representative fingerprint and as its smallest doc_id."""
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    found = components(links(fps.select("fp"), max_bits, n_parts, bucket_limit)) \
        .withColumnRenamed("node", "fp")
    classed = fps.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = classed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return classed.join(names, "root").select("fp", "root", "component_id")


def dedup(docs: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id, rows without one last, then any equal row."""
    keep = docs.columns
    rows = materialize(with_fingerprint(docs, text, shingle, "__fp").withColumn(
        "__row", F.monotonically_increasing_id()), "simhash-rows")
    ids = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("__fp").alias("fp"), "__row")
    classes = near_duplicates(ids.select("doc_id", "fp"), max_bits).select("fp", "root")
    first = ids.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__row")).alias("f"))
    chosen = first.join(classes, "fp").groupBy("root").agg(F.min("f").alias("f")) \
        .select(F.col("f")["__row"].alias("__row"))
    return rows.join(chosen, "__row", "left_semi").select(*keep)
