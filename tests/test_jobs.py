"""Batch job outputs (K1, K2, K5, K9) and remaining operator surfaces."""
import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnscope.learning import models as M
from txnscope.operators import analytics as an
from txnscope.operators import metrics as me
from txnscope.plans import batch_job
from txnscope.sources import readers as R
from txnscope.sources.ledger import ledger


def test_run_analyses_writes_every_table(spark, tmp_dir):
    txns = ledger(spark, SF_SMALL)
    out = batch_job.run_analyses(spark, txns, tmp_dir)
    assert set(out) == {*batch_job.ANALYSES, "transaction_summary", "cleaned"}
    assert spark.read.parquet(out["spark_type_stats"]).count() == 5
    assert spark.read.parquet(out["spark_high_risk_senders"]).count() <= 50
    cleaned = spark.read.parquet(out["cleaned"])
    assert "nameOrig" not in cleaned.columns and "type" not in cleaned.columns
    assert cleaned.count() == txns.count()
    # overwrite: a second run replaces, not appends
    batch_job.run_analyses(spark, txns, tmp_dir, export=False)
    assert spark.read.parquet(out["spark_type_stats"]).count() == 5


def test_train_and_save_report(spark, tmp_dir):
    spec = M.ModelSpec(rf_trees=3, rf_depth=3, gbt_iter=2, gbt_depth=2, lr_iter=10)
    out = batch_job.train_and_save(ledger(spark, SF_SMALL), tmp_dir, spec)
    files = [f for f in os.listdir(out["report"]) if f.endswith(".json")]
    with open(os.path.join(out["report"], files[0])) as fh:
        rep = json.loads(fh.readline())
    assert rep["best_model"] == out["best"]
    assert rep["best_reason"].startswith("Highest ROC-AUC (")
    assert {m["name"] for m in rep["models"]} == set(spec.names)
    roc = spark.read.parquet(out["roc_points"])
    assert set(r[0] for r in roc.select("model").distinct().collect()) == set(spec.names)
    assert M.load_model(out["model"]) is not None


def test_per_class_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "label int, prediction int")
    rows = {r.class_name: r for r in me.per_class_report(df).collect()}
    assert rows["Fraud"].precision == 0.5 and rows["Fraud"].recall == 0.5
    assert rows["Legit"].support == 3 and abs(rows["Legit"].precision - 2 / 3) < 1e-12


def test_read_collection_drops_store_id(spark):
    spark.createDataFrame([(1, "x")], "_id int, v string").createOrReplaceTempView("coll")
    df = R.read_collection(spark, "coll")
    assert df.columns == ["v"]
    assert R.has_rows(spark, "coll")
    assert not R.has_rows(spark, "no_such_table")


def test_hourly_pattern_modes(spark):
    txns = ledger(spark, SF_SMALL)
    exact = an.hourly_pattern(txns)
    approx = an.hourly_pattern(txns, exact_threshold=False)
    assert exact.count() == approx.count()
    peaks = exact.filter("is_peak_fraud_hour").count()
    assert 0 < peaks <= exact.count()


def test_seeded_shuffle_is_stable(spark):
    txns = ledger(spark, SF_SMALL)
    a = [r[0] for r in an.seeded_shuffle(txns).select("txn_id").collect()]
    b = [r[0] for r in an.seeded_shuffle(txns.repartition(3)).select("txn_id").collect()]
    assert a == b and sorted(a) == list(range(1000))


def test_first_n_by_hash_equals_ordered_limit(spark):
    txns = ledger(spark, SF_SMALL)
    for n in (1, 37, 999, 1000, 5000):
        got = sorted(r[0] for r in an.first_n_by_hash(txns, n).select("txn_id").collect())
        want = sorted(r[0] for r in txns.orderBy(F.xxhash64("txn_id", F.lit(42)), "txn_id")
                      .limit(n).select("txn_id").collect())
        assert got == want, n


def test_csv_to_trained_model_to_evaluation(spark, tmp_dir):
    """The stored load has row ids, so training runs on it; the evaluation follows its threshold."""
    from txnscope.schema import TXN_COLUMNS
    ledger(spark, SF_SMALL).select(*TXN_COLUMNS).write.option("header", True).csv(f"{tmp_dir}/csv")
    R.load_transactions(spark, f"{tmp_dir}/csv", f"{tmp_dir}/txns", f"{tmp_dir}/fraud", f"{tmp_dir}/staging")
    txns = spark.read.parquet(f"{tmp_dir}/txns")
    assert txns.count() == txns.select("txn_id").distinct().count() == 1000
    fraud = spark.read.parquet(f"{tmp_dir}/fraud")
    assert fraud.join(txns.where("isFraud = 1"), "txn_id", "left_anti").isEmpty()
    spec = M.ModelSpec(rf_trees=3, rf_depth=3, gbt_iter=2, gbt_depth=2, lr_iter=10, names=["Logistic Regression"])
    model = M.load_model(batch_job.train_and_save(txns, f"{tmp_dir}/model", spec)["model"])
    holed = txns.withColumn("amount", F.when(F.col("txn_id") == txns.first()["txn_id"], F.lit(None)).otherwise(F.col("amount")))
    flagged = {}
    for t in (0.2, 0.8):
        out = batch_job.evaluate_and_save(model, holed, f"{tmp_dir}/eval-{t}", threshold=t)
        m = spark.read.parquet(out["metrics"]).first()
        assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == 999 and m["unscored"] == 1 and m["threshold"] == t
        assert 0 <= m["average_precision"] <= 1 and 0 <= m["roc_auc"] <= 1
        got = M.score_transactions(model, holed).where("confidence is not null").count()
        assert got == 999
        flagged[t] = m["fp"] + m["tp"]
        assert spark.read.parquet(out["per_class"]).agg(F.sum("support")).first()[0] == 999
        last = spark.read.parquet(out["pr_points"]).orderBy("threshold").first()
        assert last["recall"] == 1.0
        assert spark.read.parquet(out["importances"]).count() > 0
    assert flagged[0.2] >= flagged[0.8]


def test_bounded_replay_query_takes_the_default_limit(spark):
    from tests.conftest import SF_CHECK
    from txnscope.plans import registry
    from txnscope.schema import DEFAULT_STREAM_LIMIT
    from txnscope.sources.ledger import ledger
    total = ledger(spark, SF_CHECK).count()
    assert total > 1000
    assert registry.queries()["w9_bounded_replay_choice"](spark, SF_CHECK).count() == min(total, DEFAULT_STREAM_LIMIT)


def test_command_line_jobs_from_file_to_alerts(spark, tmp_dir):
    """Load, analyse, train, evaluate, score, replay and consume, as their command lines are parsed."""
    from txnscope import jobs
    from txnscope.schema import TXN_COLUMNS
    from txnscope.sources.ledger import ledger
    ledger(spark, SF_SMALL).select(*TXN_COLUMNS).write.option("header", True).csv(f"{tmp_dir}/csv")

    def job(*argv):
        return jobs.run(spark, jobs.parser().parse_args([str(a) for a in argv]))
    assert job("load", f"{tmp_dir}/csv", f"{tmp_dir}/db")["transactions"] == 1000
    assert spark.read.parquet(f"{tmp_dir}/db/transaction_summary").agg({"total_count": "sum"}).first()[0] == 1000
    txns = f"{tmp_dir}/db/transactions"
    assert spark.read.parquet(job("analyse", txns, f"{tmp_dir}/results")["spark_type_stats"]).count() == 5
    trained = job("train", txns, f"{tmp_dir}/models", "--models", "Logistic Regression", "--lr-iter", 10)
    assert trained["best"] == "Logistic Regression"
    made = job("evaluate", trained["model"], txns, f"{tmp_dir}/evaluation", "--threshold", 0.7)
    assert spark.read.parquet(made["metrics"]).first()["threshold"] == 0.7
    assert spark.read.parquet(job("score", trained["model"], txns, f"{tmp_dir}/scores")["scores"]).count() == 1000
    assert spark.read.text(job("replay", txns, f"{tmp_dir}/few", "--limit", 10)["messages"]).count() == 10
    job("replay", txns, f"{tmp_dir}/messages")
    totals = job("consume", f"{tmp_dir}/messages", f"{tmp_dir}/stream", "--model", trained["model"], "--once")
    assert totals["processed"] == 1000
    alerts = spark.read.parquet(f"{tmp_dir}/stream/alerts").count()
    assert alerts == totals["fraud_count"] == spark.read.parquet(f"{tmp_dir}/scores").where("prediction = 1").count()

