"""Tree scoring against the fitted stages, boosting against brute force and Spark's own boosted trees."""
import itertools

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, SF_SMALL
from txnscope.learning import boosting as B
from txnscope.learning import models as M
from txnscope.learning import trees as T
from txnscope.learning.split import stratified_split
from txnscope.operators import metrics as me
from txnscope.schema import MODEL_FEATURES
from txnscope.sources.ledger import ledger


def random_tree(r, depth, features):
    if depth == 0 or r.random() < 0.15:
        return T.Node(values=(float(r.normal()), float(r.normal())))
    return T.Node((), int(r.integers(features)), float(np.round(r.normal(), 1)), random_tree(r, depth - 1, features),
                  random_tree(r, depth - 1, features))


def walk(node, row):
    while node.left is not None:
        node = node.left if row[node.feature] <= node.threshold else node.right
    return node.values


@pytest.mark.parametrize("depth", [0, 3, 6, 9])
def test_tables_end_in_the_leaves_of_a_walk(depth):
    r = np.random.default_rng(depth)
    trees = [random_tree(r, depth, 4) for _ in range(7)]
    x = np.round(r.normal(size=(300, 4)), 1)              # rows that equal thresholds
    x[:5, 1] = np.nan                                     # a missing value fails every test
    made = T.tables(trees, 4)
    want = np.array([[sum(walk(t, row)[v] for t in trees) for v in range(2)] for row in x])
    assert np.allclose(made.totals(x), want, atol=1e-12)


def test_tables_beyond_the_bound_are_not_made(monkeypatch):
    monkeypatch.setattr(T, "MAX_TABLE_BYTES", 10)
    assert T.tables([random_tree(np.random.default_rng(1), 5, 3)], 3) is None


@pytest.mark.parametrize("name", ["Random Forest", "GBT"])
def test_compiled_ensembles_equal_their_stages(spark, name):
    txns = ledger(spark, SF_SMALL)
    data = M.prepare(txns)
    spec = M.ModelSpec(rf_trees=12, rf_depth=9, gbt_iter=6, gbt_depth=4)
    model = M.pipeline(M.classifier(name, spec, 1000)).fit(M.with_weights(data))
    assert T.compiled(model.stages[-1]) is not None
    want = {r.txn_id: (r.p, r.pred) for r in model.transform(data).select(
        "txn_id", vector_to_array("probability")[1].alias("p"), F.col("prediction").cast("int").alias("pred")).collect()}
    bad = txns.limit(4).withColumn("amount", F.lit(None).cast("double")).withColumn("txn_id", F.col("txn_id") + 10 ** 6)
    got = M.scored_features(model, txns.unionByName(bad)).select("txn_id", "score", "prediction").collect()
    assert len(got) == 1004
    for r in got:
        if r.txn_id >= 10 ** 6:
            assert r.score is None and r.prediction is None
        else:
            assert abs(r.score - want[r.txn_id][0]) < 1e-12 and r.prediction == want[r.txn_id][1]


def test_level_sums_against_brute_force(spark):
    r = np.random.default_rng(4)
    rows = [(int(r.random() < 0.3), float(np.round(r.normal(), 1)), float(r.integers(5))) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, a double, b double").repartition(5)
    cuts = [[-0.5, 0.0, 0.7], [1.0, 3.0]]
    packed = B.binned(df, ["a", "b"], cuts, "y", 99.0)
    tree = {"feature": [0, -1, -1], "bin": [1, 0, 0], "left": [1, -1, -1], "gain": [1.0, 0.0, 0.0], "weight": [0.0, 0.3, -0.2]}
    got = {(s.node, s.feature, s.bin): (s.n, s.g / 2 ** 20, s.h / 2 ** 20)
           for s in B.level_sums(packed, 2, [tree], tree, [1, 2], 20).collect()}
    want = {}
    for y, a, b in rows:
        node = 1 if a <= 0.0 else 2
        p = 1 / (1 + np.exp(-tree["weight"][node]))
        w = 99.0 if y else 1.0
        for f, (v, c) in enumerate(((a, cuts[0]), (b, cuts[1]))):
            key = (node, f, sum(e < v for e in c))
            n, g, h = want.get(key, (0, 0.0, 0.0))
            want[key] = (n + 1, g + w * (p - y), h + w * p * (1 - p))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and np.allclose(got[k][1:], want[k][1:], atol=1e-3)


def test_first_split_is_the_best_of_all(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=(300, 2))
    y = ((x[:, 1] > 0.4) ^ (r.random(300) < 0.1)).astype(int)
    df = spark.createDataFrame([(int(b), float(a0), float(a1)) for b, (a0, a1) in zip(y, x)], "y int, a double, b double")
    spec = B.BoostSpec(rounds=1, depth=1, positive_weight=1.0, bins=32)
    model = B.fit(df, ["a", "b"], "y", spec)
    best = None
    for f, cuts in enumerate(model.cuts):
        for b, cut in enumerate(cuts):
            left = x[:, f] <= cut
            gain = sum(((0.5 - y[s]).sum()) ** 2 / (0.25 * s.sum() + 1) for s in (left, ~left))
            if min(left.sum(), (~left).sum()) * 0.25 >= 1 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, b, [-(0.5 - y[s]).sum() / (0.25 * s.sum() + 1) * 0.1 for s in (left, ~left)])
    tree = model.trees[0]
    assert (tree["feature"][0], tree["bin"][0]) == best[1:3]
    assert np.allclose(tree["weight"][1:], best[3], atol=1e-6)


def test_boosting_is_no_worse_than_the_first_order_trees(spark, tmp_dir):
    data = M.prepare(ledger(spark, SF_CHECK))
    train, test = stratified_split(data)
    boosted = B.fit(train, spec=B.BoostSpec(rounds=12, depth=4, store_every=5))
    scored = boosted.score(test)
    auc = me.roc_auc(scored.select(F.col("isFraud").alias("label"), "score")).first()[0]
    gbt = M.pipeline(M.classifier("GBT", M.ModelSpec(gbt_iter=12, gbt_depth=4), 8000)).fit(M.with_weights(train, mode="positive"))
    old = me.roc_auc(M.score_features(gbt, test).select(F.col("isFraud").alias("label"), "score")).first()[0]
    assert auc >= old - 0.01
    # The same trees from another partitioning, and after saving.
    once = B.fit(train, spec=B.BoostSpec(rounds=2, depth=3))
    again = B.fit(train.repartition(7), spec=B.BoostSpec(rounds=2, depth=3), cuts=once.cuts)
    assert again.trees == once.trees
    boosted.save(spark, f"{tmp_dir}/model")
    loaded = B.Boosted.load(spark, f"{tmp_dir}/model")
    assert loaded == boosted and len(loaded.importances()) == len(MODEL_FEATURES)
    assert abs(sum(loaded.importances()) - 1) < 1e-9


def test_boosting_without_rows_or_with_unusable_ones(spark):
    empty = spark.createDataFrame([], "y int, a double")
    model = B.fit(empty, ["a"], "y", B.BoostSpec(rounds=2))
    assert model.trees == []
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(40)] + [(1, None), (0, float("nan")), (None, 1.0)], "y int, a double")
    model = B.fit(df, ["a"], "y", B.BoostSpec(rounds=2, depth=2, positive_weight=1.0))
    out = model.score(df).collect()
    assert len(out) == 43 and sum(r.score is None for r in out) == 2


@pytest.mark.parametrize("cells", [4, 32, 256])
def test_reduced_curves_keep_their_bounds(spark, cells):
    r = np.random.default_rng(cells)
    labels = r.integers(0, 2, 3000)
    scores = np.round(np.clip(labels * 0.25 + r.random(3000), 0, 1.2), 3)
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)], "label int, score double")
    got, run = me.curve_summary(df, cells=cells)
    full = me.roc_curve(df, drop_intermediate=False).orderBy(F.desc("threshold")).collect()
    area = lambda x, y: float(np.trapezoid(y, x))                                          # noqa: E731
    exact = area([p.fpr for p in full], [p.tpr for p in full])
    assert abs(exact - got["roc_auc"]) < 1e-9 and abs(me.roc_auc(df).first()[0] - got["roc_auc"]) < 1e-12
    assert abs(area(got["fpr"], got["tpr"]) - exact) < 1 / (4 * cells)
    assert len(got["fpr"]) <= 2 * (2 * cells + 1) + 1 and len(got["recall_curve"]) <= 4 * (cells + 1)
    points = np.c_[got["fpr"], got["tpr"]]
    assert all(np.abs(points - (p.fpr, p.tpr)).sum(axis=1).min() <= 1 / cells for p in full)
    assert abs(me.average_precision(df).first()[0] - got["average_precision"]) < 1e-9
    whole = {(p.recall, p.precision) for p in me.pr_curve(df).collect()}
    kept = list(zip(got["recall_curve"], got["precision_curve"]))
    assert set(kept) <= whole
    for q, p in whole:
        near = [b for a, b in kept if int(a * cells) == int(q * cells)]
        assert min(near) <= p <= max(near)
    assert me.roc_points(run).count() == me.roc_curve(df).count()


def test_comparison_counts_unscored_rows_and_holds_curves(spark):
    L = ledger(spark, SF_SMALL)
    spec = M.ModelSpec(rf_trees=3, rf_depth=3, lr_iter=10, names=["Random Forest", "Logistic Regression"])
    broken = L.withColumn("amount", F.when(F.col("txn_id") % 10 == 0, F.lit(None)).otherwise(F.col("amount")))
    report = M.compare_models(broken, spec).report.first()
    for m in report.models:
        assert sum(itertools.chain(*m.confusion_matrix)) + m.unscored == 200 and 5 < m.unscored < 40
        assert m.fpr[0] == m.tpr[0] == 0.0 and m.fpr[-1] == m.tpr[-1] == 1.0 and len(m.fpr) == len(m.tpr)
        assert 0 <= m.average_precision <= 1 and len(m.precision_curve) == len(m.recall_curve)
