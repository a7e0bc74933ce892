"""Second-order boosted trees over quantile histograms (M5).

Features are cut at approximate quantiles (one aggregate), and every row is
kept as small bin numbers with its label, weight and margin.  A level of a
tree is one job: tasks add the first and second derivatives of the weighted
logistic loss by (node, feature, bin), Spark sums these partial histograms, and
the driver, which sees nodes * features * bins sums and no rows, chooses the
splits.  Derivatives are added as whole numbers of 2^-bits, so the sums, and
with them the trees made from given cuts, do not depend on the partitioning (a sketch's
cuts do within its error).

Leaf weights are -G / (H + l2); a split gains
GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.functions import features as fx
from txnscope.learning import trees as tr
from txnscope.schema import MODEL_FEATURES, TARGET
from txnscope.session import materialize

c = F.col


@dataclass(frozen=True)
class BoostSpec:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    positive_weight: float = 99.0
    l2: float = 1.0
    min_hessian: float = 1.0
    min_gain: float = 0.0
    bins: int = 64
    #: Trees between two stored versions of the margins; what a level job adds up for itself.
    store_every: int = 10


@dataclass
class Boosted:
    """Flat trees: per node feature (-1 in a leaf), bin, left child (right is left + 1) and weight."""
    features: list[str]
    cuts: list[list[float]]
    spec: BoostSpec = field(default_factory=BoostSpec)
    trees: list[dict[str, list]] = field(default_factory=list)

    def nodes(self) -> list[tr.Node]:
        def build(t: dict[str, list], i: int) -> tr.Node:
            if t["feature"][i] < 0:
                return tr.Node(values=(t["weight"][i],))
            f, left = t["feature"][i], t["left"][i]
            return tr.Node((), f, self.cuts[f][t["bin"][i]], build(t, left), build(t, left + 1))
        return [build(t, 0) for t in self.trees]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with score and prediction, null where an input is null or NaN."""
        made = tr.tables(self.nodes(), len(self.features))
        if made is None:
            raise ValueError("the ensemble's tables are too large to broadcast; use fewer or shallower trees")
        fn = tr.scorer(df.sparkSession, made, "margin")
        out = tr.with_scores(df, fn(*[c(f).cast("double") for f in self.features]))
        usable = fx.unusable_inputs(self.features).isNull()
        return out.withColumn("score", F.when(usable, c("score"))).withColumn("prediction", F.when(usable, c("prediction")))

    def importances(self) -> list[float]:
        """Share of the total gain by feature."""
        total = np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t["feature"], t["gain"], strict=True):
                if f >= 0:
                    total[f] += g
        return (total / total.sum()).tolist() if total.sum() else total.tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "model string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        kept = json.loads(spark.read.text(path).first()[0])
        return Boosted(**{**kept, "spec": BoostSpec(**kept["spec"])})


def quantile_cuts(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Distinct approximate quantiles of each feature from mergeable sketches, in one aggregate."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = df.agg(*[F.percentile_approx(c(f).cast("double"), at, bins * 100).alias(str(i)) for i, f in enumerate(features)]).first()
    return [sorted(set(row[i] or [])) for i in range(len(features))]


def binned(df: DataFrame, features: list[str], cuts: list[list[float]], label: str, positive_weight: float) -> DataFrame:
    """(label, weight, bins, margin): bin b of a feature means that b of its cuts lie below the value."""
    edges = [np.array(x) for x in cuts]
    if max(map(len, cuts), default=0) > 255:
        raise ValueError("at most 255 cuts a feature")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([np.searchsorted(e, b.column(i + 1).to_numpy(zero_copy_only=False), side="left")
                                 for i, e in enumerate(edges)]).astype(np.uint8)
            y = b.column(0)
            one = y.to_numpy() == 1
            yield pa.RecordBatch.from_arrays(
                [y, pa.array(np.where(one, positive_weight, 1.0)),
                 pa.Array.from_buffers(pa.binary(len(edges)), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))])
                 .cast(pa.binary()), pa.array(np.zeros(len(x)))], names=["label", "weight", "bins", "margin"])

    rows = df.where(fx.unusable_inputs(features).isNull() & c(label).isNotNull())
    return rows.select(c(label).cast("int"), *[c(f).cast("double") for f in features]) \
        .mapInArrow(pack, "label int, weight double, bins binary, margin double")


def _bins(batch: pa.RecordBatch, n: int) -> np.ndarray:
    col = batch.column("bins").cast(pa.binary(n))
    return np.frombuffer(col.buffers()[1], np.uint8)[col.offset * n:(col.offset + len(col)) * n].reshape(-1, n)


def _walk(x: np.ndarray, tree: dict[str, list]) -> np.ndarray:
    """Node of the (unfinished) tree that each row is in."""
    feature, cut, left = (np.array(tree[k]) for k in ("feature", "bin", "left"))
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        f = feature[at]
        go = f >= 0
        if not go.any():
            return at
        at = np.where(go, left[at] + (x[rows, np.maximum(f, 0)] > cut[at]), at)


def _margins(batch: pa.RecordBatch, x: np.ndarray, trees: list[dict[str, list]]) -> np.ndarray:
    margin = batch.column("margin").to_numpy().copy()
    for t in trees:
        margin += np.array(t["weight"])[_walk(x, t)]
    return margin


def level_sums(rows: DataFrame, n_features: int, grown: list[dict[str, list]], tree: dict[str, list], open_nodes: list[int],
               bits: int) -> DataFrame:
    """(node, feature, bin, n, g, h): rows and sums of the derivatives, in units of 2^-bits, of the open nodes."""
    unit = 2.0 ** bits

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(len(tree["feature"]), -1)
        slot[open_nodes] = np.arange(len(open_nodes))
        total = np.zeros((3, len(open_nodes), n_features, 256), np.int64)
        for b in batches:
            x = _bins(b, n_features)
            p = 1.0 / (1.0 + np.exp(-_margins(b, x, grown)))
            y, w = b.column("label").to_numpy(), b.column("weight").to_numpy()
            at = slot[_walk(x, tree)]
            g, h = np.rint(w * (p - y) * unit).astype(np.int64), np.rint(w * p * (1 - p) * unit).astype(np.int64)
            for f in range(n_features):
                cell = (at * 256 + x[:, f])[at >= 0]
                order = np.argsort(cell, kind="stable")
                cells, start = np.unique(cell[order], return_index=True)
                if len(cells):
                    for v, own in enumerate((np.ones(len(at), np.int64), g, h)):
                        total[v, cells // 256, f, cells % 256] += np.add.reduceat(own[at >= 0][order], start)
        node, f, b = np.nonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(open_nodes, np.int32)[node]), pa.array(f, pa.int32()), pa.array(b, pa.int32()),
             *[pa.array(total[v, node, f, b]) for v in range(3)]], names=["node", "feature", "bin", "n", "g", "h"])

    return rows.mapInArrow(sums, "node int, feature int, bin int, n bigint, g bigint, h bigint") \
        .groupBy("node", "feature", "bin").agg(*[F.sum(v).alias(v) for v in ("n", "g", "h")])


def _grow(tree: dict[str, list], sums: DataFrame, open_nodes: list[int], spec: BoostSpec, n_features: int,
          unit: float) -> list[int]:
    """Split the open nodes where that gains and weigh their children; returns the new open nodes."""
    hist = {n: np.zeros((2, n_features, 256)) for n in open_nodes}
    for r in sums.collect():                        # bounded by nodes * features * bins
        hist[r.node][:, r.feature, r.bin] = r.g / unit, r.h / unit
    opened = []
    for n in open_nodes:
        g, h = hist[n]
        G, H = g[0].sum(), h[0].sum()
        if not n:
            tree["weight"][n] = float(-G / (H + spec.l2) * spec.rate)
        gl, hl = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
        gr, hr = G - gl, H - hl
        gain = gl ** 2 / (hl + spec.l2) + gr ** 2 / (hr + spec.l2) - G ** 2 / (H + spec.l2)
        gain[(hl < spec.min_hessian) | (hr < spec.min_hessian)] = -np.inf
        f, b = np.unravel_index(gain.argmax(), gain.shape)
        if gain[f, b] > spec.min_gain + 1e-9:
            left = len(tree["feature"])
            tree["feature"][n], tree["bin"][n], tree["left"][n], tree["gain"][n] = int(f), int(b), left, float(gain[f, b])
            for k, v in (("feature", -1), ("bin", 0), ("left", -1), ("gain", 0.0)):
                tree[k] += [v, v]
            tree["weight"] += [float(-a[f, b] / (z[f, b] + spec.l2) * spec.rate) for a, z in ((gl, hl), (gr, hr))]
            opened += [left, left + 1]
    return opened


def fit(train: DataFrame, features: list[str] = MODEL_FEATURES, label: str = TARGET, spec: BoostSpec | None = None,
        cuts: list[list[float]] | None = None) -> Boosted:
    """Boosted trees on ``train``; rows with null or NaN inputs, or without a label, take no part."""
    spec = spec or BoostSpec()
    cuts = cuts or quantile_cuts(train, features, spec.bins)
    model = Boosted(list(features), cuts, spec)
    rows = materialize(binned(train, features, cuts, label, spec.positive_weight), "boost-rows")
    n = rows.count()
    # As fine as sums of n derivatives allow in a long.
    bits = max(0, min(32, 62 - int(np.ceil(np.log2(max(n, 1) * max(spec.positive_weight, 1.0))))))
    stored = 0
    for t in range(spec.rounds if n else 0):
        if t - stored == spec.store_every:
            recent = model.trees[stored:]

            def add(batches, recent=recent):
                for b in batches:
                    m = _margins(b, _bins(b, len(features)), recent)
                    yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(m)], names=b.schema.names)
            rows, stored = materialize(rows.mapInArrow(add, rows.schema), "boost-rows"), t
        tree = {"feature": [-1], "bin": [0], "left": [-1], "gain": [0.0], "weight": [0.0]}
        open_nodes = [0]
        for _ in range(spec.depth):
            if not open_nodes:
                break
            sums = level_sums(rows, len(features), model.trees[stored:], tree, open_nodes, bits)
            open_nodes = _grow(tree, sums, open_nodes, spec, len(features), 2.0 ** bits)
        model.trees.append(tree)
    return model
