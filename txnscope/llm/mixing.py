"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and
share all words; no target exceeds ``most`` times its source's size, the excess
is shared anew by weight.

Blocks: the mix is made of blocks of ``block_words`` words.  Highest quotients
(votes over 1, 3, 5, ...) give each source a whole number of blocks, votes being
targets, and then each shard of the source its whole number, votes being the
shard's words; blocks beyond ``most`` times a shard's words go to the source's
other shards by the next quotients.  Shards are seeded hashes of the documents,
as many for a source as its own rows ask for, of a bounded number each.  Within a shard the documents stand in seeded order, their
words laid out ``most`` times over and cut into blocks; the shard's quota takes
the first ones.  So every document is taken equally often but for the last
pass, which stops at the quota, and at most one document of a shard is cut.

The seeded order depends on ids and texts only, so reruns agree.  Everything is
keyed by (source, shard): a hot source has more shards, not larger ones.

Edge cases: null and blank texts have size 0 and are never taken; a null source
is one source, last in order; repeated rows are rows of their own, and which of
two equal rows is cut does not matter; sources without words get nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscope.llm.common import text_of, words_of
from txnscope.session import materialize


def targets(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Shares of all words by weight; a share above ``most`` times the size stops there and the rest is shared anew."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        w = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / w >= most * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = float(most * sizes[i])
            free.discard(i)
        left -= sum(out[i] for i in full)
    return out


def sainte_lague(votes: Sequence[float], seats: int) -> np.ndarray:
    """Whole seats by the highest quotients votes / (2 s + 1); equal quotients go to the first.

    Rounding votes over a common divisor gives all but a few seats; those are then moved one by one."""
    v = np.asarray(votes, dtype=np.float64)
    if not len(v) or v.sum() <= 0 or seats <= 0:
        return np.zeros(len(v), dtype=np.int64)
    got = np.floor(v * (seats / v.sum()) + 0.5).astype(np.int64)
    over = int(got.sum()) - seats
    if over < 0:
        heap = [(-x / (2 * s + 1), i) for i, (x, s) in enumerate(zip(v.tolist(), got.tolist()))]
        heapq.heapify(heap)
        for _ in range(-over):
            _, i = heap[0]
            got[i] += 1
            heapq.heapreplace(heap, (-v[i] / (2 * got[i] + 1), i))
    elif over > 0:
        heap = [(x / (2 * s - 1), -i) for i, (x, s) in enumerate(zip(v.tolist(), got.tolist())) if s]
        heapq.heapify(heap)
        for _ in range(over):
            _, i = heapq.heappop(heap)
            i = -i
            got[i] -= 1
            if got[i]:
                heapq.heappush(heap, (v[i] / (2 * got[i] - 1), -i))
    return got


def deal_blocks(words: Sequence[int], quota: int, most: int, block_words: int) -> np.ndarray:
    """Blocks of each shard: by highest quotients, none above what ``most`` times its words fill, the rest to the others."""
    room = np.asarray(words, dtype=np.int64) * most
    top = -(-room // block_words)
    got = np.minimum(sainte_lague(words, quota), top)
    while True:
        left = (quota * block_words - int(np.minimum(got * block_words, room).sum())) // block_words
        free = np.nonzero(got < top)[0]
        if left <= 0 or not len(free):
            return got
        # Quotients go on from the blocks that the open shards have.
        votes = np.asarray(words, dtype=np.float64)[free]
        more = np.maximum(sainte_lague(votes, int(got[free].sum()) + left) - got[free], 0)
        order = np.argsort(-votes / (2 * got[free] + 2 * more + 1), kind="stable")
        more = more if more.sum() else np.bincount(order[:left], minlength=len(free))
        over = np.cumsum(more) - left                 # no more than are left, however the quotients round
        more = np.maximum(np.minimum(more, more - over), 0)
        got[free] = np.minimum(got[free] + more, top[free])


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, block_words: int = 8, seed: int = 42,
        shard_docs: int = 4000, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs`` (doc_id, text, source), and the columns in ``carry``."""
    spark = docs.sparkSession
    t = text_of()
    rows = docs.select(
        *[F.col(c).alias(f"__in_{c}") for c in carry], F.col("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("__source"),
        F.size(words_of(t)).cast("bigint").alias("size"), F.xxhash64(F.col("doc_id"), t, F.lit(seed)).alias("__order"))
    rows = materialize(rows, "mix-rows")
    # One row for each source.  Names of corpora: the list is small by nature, and refused beyond 100,000.
    sources = rows.groupBy("__source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(100_001).collect()
    if len(sources) > 100_000:
        raise ValueError("more than 100,000 sources")
    sources = sorted(sources, key=lambda r: (r["__source"] == "null", r["__source"]))
    sizes = [r["size"] for r in sources]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sources))], most)
    quotas = sainte_lague(aims, round(sum(aims) / block_words))
    book = spark.createDataFrame(
        [(r["__source"], r["size"], aim, int(q), max(1, r["n"] // shard_docs)) for r, aim, q in zip(sources, aims, quotas)],
        "__source string, source_size bigint, target double, quota bigint, __shards bigint")
    rows = rows.join(F.broadcast(book.select("__source", "__shards")), "__source") \
        .withColumn("__shard", F.pmod(F.xxhash64("__order"), F.col("__shards"))).drop("__shards")
    cells = rows.groupBy("__source", "__shard").agg(F.sum("size").alias("words"))

    def deal(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("__shard")
        cell["blocks"] = deal_blocks(cell["words"].to_numpy(), int(cell["quota"].iloc[0]), most, block_words)
        return cell[["__source", "__shard", "words", "source_size", "target", "blocks"]]
    # One narrow row for each shard of ``shard_docs`` documents.
    dealt = cells.join(F.broadcast(book.drop("__shards")), "__source").groupBy("__source").applyInPandas(
        deal, "__source string, __shard bigint, words bigint, source_size bigint, target double, blocks bigint")
    w = Window.partitionBy("__source", "__shard").orderBy("__order", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(w), F.lit(0))
    out = rows.withColumn("__before", before).join(dealt, ["__source", "__shard"])
    quota = F.least(F.col("blocks") * block_words, F.col("words") * most)
    passes = F.when(F.col("words") > 0, F.floor(quota / F.greatest(F.col("words"), F.lit(1)))).otherwise(0)
    rest = quota - passes * F.col("words")
    part = F.least(F.greatest(rest - F.col("__before"), F.lit(0)), F.col("size"))
    return out.select(*[F.col(f"__in_{c}").alias(c) for c in carry if c != "doc_id"], "doc_id", "size", "source_size",
                      "target", (passes * F.col("size") + part).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: a row for each time a document is taken, the last cut to the words taken; columns as in ``docs``."""
    got = mix(docs.withColumns({f"__own_{c}": F.col(c) for c in docs.columns}),
              carry=[f"__own_{c}" for c in docs.columns], **how).where("taken > 0")
    copies = got.withColumn("__left", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int")),
        lambda i: F.least(F.col("taken") - i * F.col("size"), F.col("size")))))
    cut = F.col("__left") < F.col("size")
    text = F.when(cut, F.array_join(F.slice(words_of(text_of("__own_text")), F.lit(1), F.col("__left").cast("int")), " ")) \
        .otherwise(F.col("__own_text"))
    out = copies.withColumn("__text", text)
    made = {"text": F.col("__text"), "n_chars": F.length("__text").cast("bigint")}
    return out.select(*[(made[c] if c in made else F.col(f"__own_{c}")).alias(c) for c in docs.columns])
