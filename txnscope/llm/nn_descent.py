"""Approximate nearest neighbours: an NN-descent graph and greedy search on it, by largest inner product.

Equal vectors are one node.  Nodes are dealt into parts of up to ``PART`` by
the signs of random projections; a node's number is part * 2^32 + position, so
every part is known from a number alone.  The graph starts with the best
links inside a node's part and inside a random group of as many nodes.

One round of NN-descent: every node samples its links, fresh and old ones,
and is sampled by those that link to it (at most ``sample`` of each kind, by
hash, trimmed before and after the shuffle, so a node that a third of all
others link to costs no more than any other).  A part asks the others for the
vectors of the nodes it has sampled, once each; neighbours of a common node are
compared, and the best new links of each node go to its own part, where they
meet its list.  Rounds end when few links change.

A search keeps a beam of the best ``beam`` nodes for every query, all queries
at once, in groups of up to ``GROUP``: a round asks the parts for the links of
the nodes to expand, then sends each query's vector to the parts of its new
nodes, which answer with the scores that can enter its beam.  Queries travel
to the nodes and not nodes to the queries, since there are fewer of them.  It
ends when no beam holds an unexpanded node.  Queries that are indexed start at
their own node, others at fixed entries.

Parts and groups talk by messages: a row carries many records of one kind, as
the bytes of a numpy array, to one part.  Spark deals and stores a few large
rows; a row or a list for every node or link would cost it several times what
the comparisons cost.

Links are compared after one more component is added that gives all vectors
the longest one's length, so that inner products and distances agree; scores
of results are inner products of the original vectors in double precision.

Edge cases: null, zero or non-finite vectors, vectors of another length than
the commonest and rows with a null id take no part; copies are all found, the
smallest ids first; an id that occurs with several vectors counts with its
best score; an empty table gives no rows; with fewer candidates than ``k`` all
are returned that the graph reaches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscope.llm.vectors import finite, matrix, usable
from txnscope.session import scratch_path

#: Nodes of a part, and queries of a group: they bound what one task holds.  Small tables have LEAST parts and groups,
#: so that they use a cluster's cores and their traffic grows with the rows.
PART, GROUP, LEAST = 8192, 512, 16
#: Nodes of a part and parts at most, as bits: two positions and a part make one key.
BITS = 21
#: Bytes of a message, and of the messages handed over together.
CHUNK, BATCH = 1 << 21, 1 << 24
MESSAGE = "home int, kind string, src int, n bigint, body binary"


class Tables:
    """Intermediate tables in the shared folder; each is removed when the one after next of its name is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.kept = spark, {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        # Shuffle files stay until the driver collects its garbage, which is little here.
        self.spark._jvm.System.gc()
        old = self.kept.setdefault(name, [])
        old.append(path)
        if len(old) > 2:
            self.remove(old.pop(0))
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def clear(self, *names: str) -> None:
        for name in names:
            for path in self.kept.pop(name, []):
                self.remove(path)


@dataclass(frozen=True)
class Index:
    """nodes (node, ids, vec), messages of the parts' vectors and links, and the numbers that the search needs."""
    nodes: DataFrame
    held: DataFrame
    links: DataFrame
    vectors: Vectors
    parts: int
    entries: list[int]
    tables: Tables


@dataclass(frozen=True)
class Vectors:
    """Vectors as bytes, which Spark moves as they are."""
    dims: int
    kind: str                                                   # numpy's name of the number type

    @property
    def record(self) -> np.dtype:
        return np.dtype([("node", "<i8"), ("vec", self.kind, (self.dims,))])

    @property
    def answer(self) -> np.dtype:
        """A lifted vector with the least similarity that its node's list takes."""
        return np.dtype([("node", "<i8"), ("worst", "<f4"), ("vec", "<f4", (self.dims + 1,))])

    def records(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        return records(self.record, node, x)

    def pack(self, x: np.ndarray) -> pa.Array:
        x = np.ascontiguousarray(x, self.kind)
        size = self.dims * x.itemsize
        return pa.Array.from_buffers(pa.binary(size), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())

    def unpack(self, column: pa.Array) -> np.ndarray:
        if not len(column):
            return np.zeros((0, self.dims), self.kind)
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(self.kind).reshape(-1, self.dims)


def mixed(*numbers) -> np.ndarray:
    """A hash of whole numbers, the same in every task."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for v in numbers:
            h = (np.asarray(v).astype(np.uint64) ^ h) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
    return h


def first_of(group: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first ``most`` by ``order`` (whole numbers under 2^40) of each group, grouped and in order."""
    if not len(group):
        return np.zeros(0, np.int64)
    g = np.unique(group, return_inverse=True)[1]
    at = np.argsort((g.astype(np.uint64) << np.uint64(40)) | order.astype(np.uint64))
    return at[ranks(g[at]) < most]


def ranks(group: np.ndarray) -> np.ndarray:
    """Rank of each element in its run of equal numbers."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    return np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))


def distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers (``np.unique`` hashes them, which takes many times a sort)."""
    v = np.sort(numbers)
    return v[np.r_[True, v[1:] != v[:-1]]] if len(v) else v


def nearest_in_rows(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest numbers of each row."""
    blocks = s.shape[1] // 32
    if blocks < 2 * k:
        top = np.argpartition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k:]
        return np.repeat(np.arange(len(s)), k), top.ravel()
    # At least k numbers of a row reach the k-th largest of its blocks' largest.
    most = s[:, :32 * blocks].reshape(len(s), 32, blocks).max(axis=1)
    least = np.partition(most, blocks - k, axis=1)[:, blocks - k]
    hit = np.flatnonzero(s >= least[:, None])
    row, col = np.divmod(hit, s.shape[1])
    top = first_of(row, falling(s.ravel()[hit]), k)
    return row[top], col[top]


def by_hash(*numbers) -> np.ndarray:
    return mixed(*numbers) >> np.uint64(24)


def falling(x: np.ndarray) -> np.ndarray:
    """Whole numbers under 2^32 in the order of falling float32 numbers."""
    b = np.ascontiguousarray(x, np.float32).view(np.uint32)
    return ~np.where(b >> 31, ~b, b | np.uint32(1 << 31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of a list column."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), np.asarray(column.flatten().to_numpy(zero_copy_only=False))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors over the longest one's length, with one more component that makes them all as long."""
    x = x.astype(np.float64) / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
    return np.c_[x, rest].astype(np.float32)


# --- messages
NODE = np.dtype([("node", "<i8")])
GRAPH = np.dtype([("node", "<i8"), ("nbr", "<i8"), ("sim", "<f4"), ("fresh", "?")])
MEMBER = np.dtype([("node", "<i8"), ("nbr", "<i8"), ("fresh", "?")])
LINK = np.dtype([("node", "<i8"), ("nbr", "<i8")])
WORST = np.dtype([("node", "<i8"), ("sim", "<f4")])
BEAM = np.dtype([("q", "<u4"), ("node", "<i8"), ("sim", "<f8"), ("done", "?")])
PAIR = np.dtype([("q", "<u4"), ("node", "<i8")])
START = np.dtype([("q", "<i8"), ("node", "<i8")])
HIT = np.dtype([("q", "<u4"), ("node", "<i8"), ("sim", "<f8")])


def records(kind: np.dtype, *columns) -> np.ndarray:
    out = np.empty(len(columns[0]), kind)
    for name, values in zip(kind.names, columns, strict=True):
        out[name] = values
    return out


def part_of(node: np.ndarray) -> np.ndarray:
    return (node >> 32).astype(np.int32)


def position(node: np.ndarray) -> np.ndarray:
    return node & 0xFFFFFFFF


def pair_key(first: np.ndarray, node: np.ndarray) -> np.ndarray:
    """A number for a position or query and a node, in their order."""
    return (first.astype(np.uint64) << np.uint64(2 * BITS)) | (part_of(node).astype(np.uint64) << np.uint64(BITS)) \
        | position(node).astype(np.uint64)


def node_of(key: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << BITS) - 1)
    return (((key >> np.uint64(BITS)) & low) << np.uint64(32) | (key & low)).astype(np.int64)


@dataclass(frozen=True)
class Post:
    """Records of a kind for a part or group; ``n`` is a number of its own."""
    home: int
    kind: str
    body: np.ndarray
    src: int = 0
    n: int = 0


def posts(kind: str, home: np.ndarray, body: np.ndarray, src: int = 0) -> Iterator[Post]:
    """Records dealt to their homes, in messages of up to CHUNK bytes."""
    at = np.argsort(home, kind="stable")
    home = home[at]
    step = max(1, CHUNK // body.dtype.itemsize)
    cuts = np.r_[0, np.flatnonzero(home[1:] != home[:-1]) + 1, len(home)]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        for a in range(lo, hi, step):
            yield Post(int(home[lo]), kind, body.take(at[a:min(a + step, hi)]), src)


def own(kind: str, home: int, body: np.ndarray, n: int = 0) -> Iterator[Post]:
    """Records that stay in their part; at least one message."""
    step = max(1, CHUNK // body.dtype.itemsize)
    for a in range(0, max(1, len(body)), step):
        yield Post(home, kind, body[a:a + step], home, 0 if a else n)


def mailed(sent: Iterator[Post]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in held], pa.int32()), pa.array([p[1] for p in held], pa.string()),
             pa.array([p[2] for p in held], pa.int32()), pa.array([p[3] for p in held], pa.int64()),
             pa.array([p[4] for p in held], pa.binary())], names=["home", "kind", "src", "n", "body"])
    for p in sent:
        held.append((p.home, p.kind, p.src, p.n, p.body.tobytes()))
        size += len(held[-1][-1])
        if size > BATCH:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


class Mail:
    """What a part or group has received."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.home, self.held = None, {}
        for b in batches:
            for home, kind, src, body in zip(*[b.column(n).to_pylist() for n in ("home", "kind", "src", "body")], strict=True):
                self.home = home
                self.held.setdefault(kind, []).append((src, body))

    def take(self, kind: str, dtype: np.dtype) -> np.ndarray:
        return self.taken(kind, dtype)[0]

    def taken(self, kind: str, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """All records of a kind, and the sender of each."""
        got = self.held.pop(kind, [])
        if not got:
            return np.zeros(0, dtype), np.zeros(0, np.int32)
        sizes = [len(body) // dtype.itemsize for _, body in got]
        return np.frombuffer(b"".join(body for _, body in got), dtype), np.repeat([src for src, _ in got], sizes)


def exchanged(df: DataFrame, parts: int, fn: Callable[[int, Mail], Iterator[Post]]) -> DataFrame:
    """Messages brought to their homes, and what ``fn`` sends from there."""
    def run(batches):
        mail = Mail(batches)
        if mail.home is not None:
            yield from mailed(fn(mail.home, mail))
    return df.repartitionById(parts, F.col("home")).mapInArrow(run, MESSAGE)


# --- nodes
def _nodes(rows: DataFrame, vectors: Vectors, most_ids: int, tables: Tables, seed: int) -> DataFrame:
    """(node, ids, vec): distinct vectors with their ``most_ids`` smallest ids."""
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("key"))
    classes = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= most_ids) \
        .groupBy("vec").agg(F.sort_array(F.collect_list("key")).alias("ids"))
    classes = tables.store(classes, "ann-classes")
    n = classes.count()
    normals = np.random.default_rng(seed).standard_normal((vectors.dims, 16)).astype(np.float32)
    ids = classes.schema["ids"].dataType.simpleString()

    def coded(batches):
        for b in batches:
            signs = vectors.unpack(b.column("vec")) @ normals > 0
            yield pa.RecordBatch.from_arrays([b.column("ids"), b.column("vec"), pa.array(signs @ (1 << np.arange(16)), pa.int32())],
                                             names=["ids", "vec", "code"])

    def numbered(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 32
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + b.num_rows), pa.int64()), b.column("ids"),
                                              b.column("vec")], names=["node", "ids", "vec"])
            at += b.num_rows

    keyed = classes.mapInArrow(coded, f"ids {ids}, vec binary, code int").withColumn("tie", F.xxhash64(F.col("ids")[0]))
    dealt = keyed.repartitionByRange(parts_of(n, PART), "code", "tie").sortWithinPartitions("code", "tie", F.col("ids")[0])
    dealt = tables.store(dealt.select("ids", "vec").mapInArrow(numbered, f"node bigint, ids {ids}, vec binary"), "ann-nodes")
    # Parts of equal size, however many partitions numbered the nodes and however even they are.
    part = F.shiftright("node", 32).cast("int")
    counts = {r[0]: r[1] for r in dealt.groupBy(part).count().collect()}
    before = np.cumsum([0] + [counts.get(p, 0) for p in range(max(counts, default=0))]).tolist()
    parts = parts_of(n, PART)
    size = F.lit(max(1, -(-n // parts))).cast("bigint")
    order = F.get(F.lit(before).cast("array<bigint>"), part) + F.col("node").bitwiseAND(F.lit(0xFFFFFFFF))
    return dealt.withColumn("node", F.shiftleft(F.call_function("div", order, size), 32) + order % size)


def parts_of(n: int, size: int) -> int:
    """Parts for n nodes or queries; tiny tables have fewer, so that a part holds others to link to."""
    return max(1, min(LEAST, n // 32), -(-n // size))


def _vector_mail(nodes: DataFrame, vectors: Vectors, kind: str, home: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Vectors for the parts that ``home`` names."""
    def send(batches):
        def sent():
            for b in batches:
                node = b.column("node").to_numpy()
                yield from posts(kind, home(node), vectors.records(node, vectors.unpack(b.column("vec"))))
        yield from mailed(sent())
    return nodes.select("node", "vec").mapInArrow(send, MESSAGE)


def _first_links(vectors: Vectors, longest: float, k: int):
    """The best k links of each node to others of its part (v), and as many of its random group (o)."""
    def best(number: np.ndarray, x: np.ndarray) -> Iterator[Post]:
        k_here = min(k, len(x) - 1)
        if k_here < 1:
            return
        for lo in range(0, len(x), 512):
            s = x[lo:lo + 512] @ x.T
            s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
            row, col = nearest_in_rows(s, k_here)
            found = records(GRAPH, number[lo + row], number[col], s[row, col], True)
            yield from posts("p", part_of(found["node"]), found)

    def start(home: int, mail: Mail) -> Iterator[Post]:
        for kind in ("v", "o"):
            held = mail.take(kind, vectors.record)
            held = held.take(np.argsort(held["node"]))
            yield from best(held["node"], lifted(held["vec"], longest))
    return start


def _sampled(node: np.ndarray, nbr: np.ndarray, fresh: np.ndarray, turn: int, sample: int) -> np.ndarray:
    """Links that a node takes into this round: up to ``sample`` fresh and as many old ones."""
    mask = np.zeros(len(node), bool)
    mask[first_of(node * 2 + fresh, by_hash(node, nbr, turn), sample)] = True
    return mask


def _merged(k: int, turn: int, sample: int):
    """Each node's best k links of its list (g) and the new ones (p), and what it samples in ``turn``: its links (f, to
    its part), itself (r, to its links' parts) and its list's worst (w).  Sampled links are no longer fresh."""
    def merge(home: int, mail: Mail) -> Iterator[Post]:
        old, new = mail.take("g", GRAPH), mail.take("p", GRAPH)
        both = np.concatenate([old, new])
        stored = np.arange(len(both)) < len(old)
        # A stored link comes before its repetitions.
        key = (pair_key(position(both["node"]), both["nbr"]) << np.uint64(1)) | (~stored).astype(np.uint64)
        at = np.argsort(key)
        key = key[at] >> np.uint64(1)
        at = at[np.r_[True, key[1:] != key[:-1]]] if len(at) else at
        both, stored = both.take(at), stored[at]
        top = first_of(both["node"], falling(both["sim"]), k)
        graph, added = both.take(top), int((~stored[top]).sum())
        node, nbr, fresh = (np.ascontiguousarray(graph[c]) for c in ("node", "nbr", "fresh"))
        use = _sampled(node, nbr, fresh, turn, sample)
        graph["fresh"] &= ~use
        yield from own("g", home, graph, added)
        last = np.flatnonzero(ranks(node) == k - 1)
        yield from own("w", home, records(WORST, node[last], graph["sim"][last]))
        node, nbr, fresh = node[use], nbr[use], fresh[use]
        yield from own("f", home, records(MEMBER, node, nbr, fresh))
        back = first_of(nbr * 2 + fresh, by_hash(nbr, node, turn, 7), sample)
        yield from posts("r", part_of(nbr[back]), records(MEMBER, nbr[back], node[back], fresh[back]))
    return merge


def _members(turn: int, sample: int):
    """Whom each node brings together (m), and the nodes whose vectors a part asks for (a)."""
    def meet(home: int, mail: Mail) -> Iterator[Post]:
        both = np.concatenate([mail.take("f", MEMBER), mail.take("r", MEMBER)])
        at = np.argsort((pair_key(position(both["node"]), both["nbr"]) << np.uint64(1)) | (~both["fresh"]).astype(np.uint64))
        both = both.take(at)
        if len(both):
            both = both[np.r_[True, (both["node"][1:] != both["node"][:-1]) | (both["nbr"][1:] != both["nbr"][:-1])]]
        node, nbr, fresh = (np.ascontiguousarray(both[c]) for c in ("node", "nbr", "fresh"))
        both = both.take(np.sort(first_of(node * 2 + fresh, by_hash(node, nbr, turn, 7), 2 * sample)))
        yield from own("m", home, both)
        yield from own("w", home, mail.take("w", WORST))
        asked = distinct(both["nbr"])
        yield from posts("a", part_of(asked), records(NODE, asked), home)
    return meet


def _answers(vectors: Vectors, longest: float):
    """The vectors that others ask for, with the worst link of their nodes (x)."""
    def answer(home: int, mail: Mail) -> Iterator[Post]:
        held, worst = mail.take("v", vectors.record), mail.take("w", WORST)
        x = np.empty((len(held), vectors.dims + 1), np.float32)
        x[position(held["node"])] = lifted(held["vec"], longest)
        least = np.full(len(held), -9.0, np.float32)
        least[position(worst["node"])] = worst["sim"]
        yield from own("m", home, mail.take("m", MEMBER))
        asked, src = mail.taken("a", NODE)
        node = asked["node"]
        at = np.argsort(src, kind="stable")
        step = max(1, CHUNK // vectors.answer.itemsize)
        for lo in range(0, len(at), step):
            part = at[lo:lo + step]
            where = position(node[part])
            yield from posts("x", src[part], records(vectors.answer, node[part], least[where], x[where]))
    return answer


def _compared(vectors: Vectors, per_part: int):
    """The best new links, up to ``per_part`` of a node from each part, among nodes that a node brings together (p)."""
    def compare(home: int, mail: Mail) -> Iterator[Post]:
        members, there = mail.take("m", MEMBER), mail.take("x", vectors.answer)
        ids, x, bar = np.ascontiguousarray(there["node"]), there["vec"], np.ascontiguousarray(there["worst"])
        at = np.argsort(ids)
        center, fresh = np.ascontiguousarray(members["node"]), np.ascontiguousarray(members["fresh"])
        who = at[np.searchsorted(ids, members["nbr"], sorter=at)] if len(ids) else np.zeros(0, int)
        start = np.flatnonzero(np.r_[True, center[1:] != center[:-1]]) if len(center) else np.zeros(0, int)
        sizes = np.diff(np.r_[start, len(center)])
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        held, chunks, waiting = none, [], 0

        def best(u, w, s):
            key = u * len(ids) + w
            order = np.argsort(key)
            key = key[order]
            order = order[np.r_[True, key[1:] != key[:-1]]] if len(order) else order
            u, w, s = u[order], w[order], s[order]
            order = np.argsort((u.astype(np.uint64) << np.uint64(32)) | falling(s))
            u = u[order]
            rank = ranks(u)
            keep = order[rank < per_part]
            # What cannot be among a node's best any more need not be looked at.
            full = rank == per_part - 1
            bar[u[full]] = np.maximum(bar[u[full]], s[order[full]])
            return u[rank < per_part], w[keep], s[keep]

        for lo in range(0, len(start), 128):
            size = sizes[lo:lo + 128]
            width = int(size.max())
            idx, new = np.full((len(size), width), -1), np.zeros((len(size), width), bool)
            r, col = np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            part = slice(start[lo], start[lo] + size.sum())
            idx[r, col], new[r, col] = who[part], fresh[part]
            near = x[idx]
            near[idx < 0] = np.nan                                  # a place without a member is near to none
            s = near @ near.transpose(0, 2, 1)
            s[:, np.arange(width), np.arange(width)] = np.nan
            ok = s > bar[idx][:, :, None]
            ok &= new[:, :, None] | new[:, None, :]
            hit = np.flatnonzero(ok)
            a, ij = np.divmod(hit, width * width)
            i, j = np.divmod(ij, width)
            chunks.append((idx[a, i], idx[a, j], s.ravel()[hit]))
            waiting += len(hit)
            if waiting > 500_000:
                held, chunks, waiting = best(*[np.concatenate(v) for v in zip(held, *chunks, strict=True)]), [], 0
        u, w, s = best(*[np.concatenate(v) for v in zip(held, *chunks, strict=True)])
        yield from posts("p", part_of(ids[u]), records(GRAPH, ids[u], ids[w], s, True))
    return compare


def _links(graph: DataFrame, parts: int, k: int) -> DataFrame:
    """Each node's own links and the best k of those that link to it (l, by node)."""
    def turned(home: int, mail: Mail) -> Iterator[Post]:
        graph = mail.take("g", GRAPH)
        yield from own("g", home, graph)
        back = first_of(graph["nbr"], falling(graph["sim"]), k)
        yield from posts("b", part_of(graph["nbr"][back]),
                         records(GRAPH, graph["nbr"][back], graph["node"][back], graph["sim"][back], False))

    def join(home: int, mail: Mail) -> Iterator[Post]:
        links, back = mail.take("g", GRAPH), mail.take("b", GRAPH)
        back = back.take(first_of(back["node"], falling(back["sim"]), k))
        key = distinct(pair_key(position(np.r_[links["node"], back["node"]]), np.r_[links["nbr"], back["nbr"]]))
        node = (key >> np.uint64(2 * BITS)).astype(np.int64) + (home << 32)
        yield from own("l", home, records(LINK, node, node_of(key)))
    return exchanged(exchanged(graph.where("kind = 'g'"), parts, turned), parts, join)


def packed(rows: DataFrame, vectors: Vectors) -> DataFrame:
    """(key, vec) with vectors as bytes; zero vectors are left out, -0.0 is 0.0."""
    def pack(batches):
        for b in batches:
            x = matrix(b.column("vec"), vectors.dims) + 0.0
            live = (x != 0).any(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("key").filter(pa.array(live)), vectors.pack(x[live])], names=["key", "vec"])
    return rows.mapInArrow(pack, f"key {rows.schema['key'].dataType.simpleString()}, vec binary")


def build(df: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 48, sample: int = 12, rounds: int = 8,
          settled: float = 0.05, most_ids: int = 21, per_part: int = 12, n_entries: int = 32, seed: int = 11) -> Index | None:
    """The graph over all usable rows; ``rounds`` at most, fewer once under ``settled`` of the links change in one."""
    spark = df.sparkSession
    tables = Tables(spark)
    rows, dims = usable(df, key, vec)
    if not dims:
        return None
    kind = "float32" if rows.schema["vec"].dataType.elementType.typeName() == "float" else "float64"
    vectors = Vectors(dims, kind)
    rows = packed(rows.where("key is not null"), vectors)
    nodes = _nodes(rows, vectors, most_ids, tables, seed)

    def lengths(batches):
        for b in batches:
            x = vectors.unpack(b.column("vec")).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(np.sqrt(np.einsum("ij,ij->i", x, x)))], names=["node", "size"])
    about = nodes.select("node", "vec").mapInArrow(lengths, "node bigint, size double") \
        .agg(F.count("*").alias("n"), F.max("node").alias("last"), F.max("size").alias("longest")).first()
    if not about["n"]:
        return None
    parts, longest = (about["last"] >> 32) + 1, about["longest"]
    held = tables.store(_vector_mail(nodes, vectors, "v", part_of), "ann-vectors")
    anyone = _vector_mail(nodes, vectors, "o", lambda node: (mixed(node, seed) % np.uint64(parts)).astype(np.int32))
    found = exchanged(held.unionByName(anyone), parts, _first_links(vectors, longest, k // 2))
    graph = tables.store(exchanged(found, parts, _merged(k, 0, sample)), "ann-graph")
    for turn in range(rounds):
        members = exchanged(graph.where("kind in ('f', 'r', 'w')"), parts, _members(turn, sample))
        answers = exchanged(members.unionByName(held), parts, _answers(vectors, longest))
        found = exchanged(answers, parts, _compared(vectors, per_part))
        both = found.unionByName(graph.where("kind = 'g'"))
        graph = tables.store(exchanged(both, parts, _merged(k, turn + 1, sample)), "ann-graph")
        changed = graph.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if changed <= settled * k * about["n"]:
            break
    links = tables.store(_links(graph, parts, k), "ann-links")
    tables.clear("ann-graph", "ann-classes")
    entries = [r.node for r in nodes.select("node").orderBy(F.xxhash64("node", F.lit(seed + 1))).limit(n_entries).collect()]
    return Index(nodes, held, links, vectors, parts, entries, tables)


# --- search
def _search(index: Index, queries: DataFrame, beam: int, expand: int, k: int) -> DataFrame:
    """queries (q, vec, start): (q, node, score) of the best k + 1 nodes of each, and of all as near as the last of them."""
    tables, vectors, parts = index.tables, index.vectors, index.parts
    groups = parts_of(queries.count(), GROUP)
    asking = np.dtype([("q", "<u4"), ("least", "<f8"), ("vec", vectors.kind, (vectors.dims,))])

    def begin(batches):
        def sent():
            for b in batches:
                q, home = b.column("q").to_numpy(), b.column("home").to_numpy()
                yield from posts("q", home, vectors.records(q, vectors.unpack(b.column("vec"))))
                row, node = flat(b.column("start"))
                yield from posts("t", home[row], records(START, q[row], node))
        yield from mailed(sent())

    def known(mail: Mail) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and vectors of the group's queries; a query's place among them stands for it in messages."""
        held = mail.take("q", vectors.record)
        held = held.take(np.argsort(held["node"]))
        return np.ascontiguousarray(held["node"]), held["vec"]

    def to_score(home: int, x: np.ndarray, least: np.ndarray, key: np.ndarray) -> Iterator[Post]:
        """Pairs to score for the nodes' parts (c), with the queries' vectors, each once for a part (k)."""
        q, node = (key >> np.uint64(2 * BITS)).astype(np.int64), node_of(key)
        yield from posts("c", part_of(node), records(PAIR, q, node), home)
        there = distinct(q * (1 << BITS) + part_of(node))
        q, part = there >> BITS, (there & ((1 << BITS) - 1)).astype(np.int32)
        for lo in range(0, len(q), 1 << 15):
            who = q[lo:lo + (1 << 15)]
            yield from posts("k", part[lo:lo + (1 << 15)], records(asking, who, least[who], x[who]), home)

    def first(home: int, mail: Mail) -> Iterator[Post]:
        number, x = known(mail)
        start = mail.take("t", START)
        key = distinct(pair_key(np.searchsorted(number, start["q"]), start["node"]))
        yield from to_score(home, x, np.full(len(number), -np.inf), key)

    def follow(home: int, mail: Mail) -> Iterator[Post]:
        """Links of the nodes to expand (n)."""
        links = mail.take("l", LINK)
        asked, src = mail.taken("e", PAIR)
        from_node, nbr = np.ascontiguousarray(links["node"]), np.ascontiguousarray(links["nbr"])
        order = np.argsort(from_node, kind="stable")
        from_node, nbr = from_node[order], nbr[order]
        lo, hi = (np.searchsorted(from_node, asked["node"], side=side) for side in ("left", "right"))
        for group in distinct(src):
            mine = np.flatnonzero(src == group)
            n = hi[mine] - lo[mine]
            at = np.repeat(lo[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield from posts("n", np.full(len(at), group, np.int32), records(PAIR, np.repeat(asked["q"][mine], n), nbr[at]))

    def unseen(home: int, mail: Mail) -> Iterator[Post]:
        number, x = known(mail)
        state, met = mail.take("s", BEAM), mail.take("n", PAIR)
        key, seen = distinct(pair_key(met["q"], met["node"])), distinct(pair_key(state["q"], state["node"]))
        key = key[seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] != key]
        least = np.full(len(number), -np.inf)
        last = np.flatnonzero(ranks(np.ascontiguousarray(state["q"])) == beam - 1)
        least[state["q"][last]] = state["sim"][last]
        yield from to_score(home, x, least, key)

    def score(home: int, mail: Mail) -> Iterator[Post]:
        """Scores that can enter the beams (h): inner products in double precision."""
        held = mail.take("v", vectors.record)
        x = np.empty((len(held), vectors.dims), vectors.kind)
        x[position(held["node"])] = held["vec"]                     # every position of a part is a node
        pairs, src = mail.taken("c", PAIR)
        asked, asked_src = mail.taken("k", asking)
        for group in distinct(src):
            mine, there = pairs[src == group], asked[asked_src == group]
            there = there.take(np.argsort(there["q"]))
            place, at = np.searchsorted(there["q"], mine["q"]), position(mine["node"])
            qx, sims = there["vec"].astype(np.float64), np.empty(len(mine))
            for lo in range(0, len(mine), 2048):
                part = slice(lo, lo + 2048)
                sims[part] = np.einsum("ij,ij->i", x[at[part]].astype(np.float64), qx[place[part]])
            in_reach = sims >= there["least"][place]
            yield from posts("h", np.full(in_reach.sum(), group, np.int32),
                             records(HIT, mine["q"][in_reach], mine["node"][in_reach], sims[in_reach]))

    def best(home: int, mail: Mail) -> Iterator[Post]:
        """The beams (s), by query and falling score, and the nodes to expand next (e)."""
        state, hits = mail.take("s", BEAM), mail.take("h", HIT)
        q, node, sim = (np.r_[state[c], hits[c]] for c in ("q", "node", "sim"))
        done = np.r_[state["done"], np.zeros(len(hits), bool)]
        at = np.lexsort((node, -sim, q))
        at = at[ranks(q[at]) < beam]
        q, node, sim, done = q[at], node[at], sim[at], done[at]
        waiting = np.flatnonzero(~done)
        chosen = waiting[ranks(q[waiting]) < expand]
        done[chosen] = True
        yield from own("s", home, records(BEAM, q, node, sim, done))
        yield from posts("e", part_of(node[chosen]), records(PAIR, q[chosen], node[chosen]), home)

    def result(batches):
        mail = Mail(batches)
        if mail.home is None:
            return
        number, _ = known(mail)
        state = mail.take("s", BEAM)
        q, sim = np.ascontiguousarray(state["q"]), np.ascontiguousarray(state["sim"])
        least = np.full(len(number), -np.inf)
        last = np.flatnonzero(ranks(q) == k)
        least[q[last]] = sim[last]
        near = sim >= least[q]
        yield pa.RecordBatch.from_arrays([pa.array(number[q[near]]), pa.array(state["node"][near]), pa.array(sim[near])],
                                         names=["q", "node", "score"])

    dealt = queries.select(F.pmod(F.xxhash64("vec"), F.lit(groups)).cast("int").alias("home"), "q", "vec", "start")
    asked = tables.store(dealt.mapInArrow(begin, MESSAGE), "ann-asked")
    vecs = asked.where("kind = 'q'")
    new = exchanged(asked, groups, first)
    beams = None
    while True:
        hits = exchanged(new.unionByName(index.held), parts, score)
        work = tables.store(exchanged(hits.unionByName(beams) if beams else hits, groups, best), "ann-work")
        beams, wanted = work.where("kind = 's'"), work.where("kind = 'e'")
        if wanted.isEmpty():
            return vecs.unionByName(beams).repartitionById(groups, F.col("home")) \
                .mapInArrow(result, "q bigint, node bigint, score double")
        links = exchanged(wanted.unionByName(index.links), parts, follow)
        new = exchanged(links.unionByName(vecs).unionByName(beams), groups, unseen)


def search(index: Index, queries: DataFrame, k: int = 20, beam: int = 160, expand: int = 16) -> DataFrame:
    """The ``k`` nearest found of each query (query_id, vec): query_id, rank, vec_id, score; never the query's own id."""
    kind = "array<float>" if index.vectors.kind == "float32" else "array<double>"
    asked = queries.select(F.col("query_id").alias("key"), F.col("vec").cast(kind).alias("vec")) \
        .where((F.size("vec") == index.vectors.dims) & F.col("key").isNotNull() & finite("vec"))
    queries = packed(asked, index.vectors).withColumnRenamed("key", "query_id").distinct()
    entries = F.array(*[F.lit(e).cast("bigint") for e in index.entries])
    # Equal vectors are searched once, from their own node if they are indexed.
    known = queries.select("vec").distinct().join(index.nodes.select("vec", "node"), "vec", "left")
    start = F.when(F.col("node").isNotNull(), F.array("node")).otherwise(entries)
    asked = index.tables.store(known.select(F.coalesce("node", F.bitwise_not(F.abs(F.xxhash64("vec")))).alias("q"), "vec",
                                            start.alias("start")), "ann-queries")
    # The first k + 1 nodes, and those as near as the last of them, hold the k nearest ids but the query's own.
    near = _search(index, asked, beam, expand, k)
    near = near.join(index.nodes.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("vec_id"))
    named = queries.join(asked.select("q", "vec"), "vec").select("query_id", "q")
    pairs = near.join(named, "q").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Nearest neighbours among all rows of those rows whose id is divisible by ``every``."""
    kind = df.select(key).schema[0].dataType.simpleString()
    index = build(df, key, vec, most_ids=k + 1)
    if index is None:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    rows, _ = usable(df, key, vec, index.vectors.dims)
    rows = rows.where(F.col("key") % every == 0)
    return search(index, rows.select(F.col("key").alias("query_id"), "vec"), k)
