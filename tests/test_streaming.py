"""Stream tests: bounded runs equal the batch result; restart keeps totals;
replayed messages are not counted twice; malformed messages go to rejects."""
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnscope.operators import alerts as al
from txnscope.sources.ledger import ledger
from txnscope.streaming import consumer as W


def _run(spark, base):
    W.run_bounded(spark, W.message_source(spark, f"{base}/in"), W.rule_scorer(),
                  f"{base}/alerts", f"{base}/stats", f"{base}/ckpt", f"{base}/rejects")


def test_bounded_stream_equals_batch_and_restarts(spark, tmp_dir):
    L = ledger(spark, SF_SMALL)
    W.replay_messages(L.filter("txn_id < 600"), f"{tmp_dir}/in")
    _run(spark, tmp_dir)
    first = W.final_totals(spark, f"{tmp_dir}/stats").first()
    assert first.processed == 600
    # second run over the same checkpoint: new messages plus replays of old ones
    W.replay_messages(L.filter("txn_id >= 600"), f"{tmp_dir}/in")
    W.replay_messages(L.filter("txn_id >= 590"), f"{tmp_dir}/in")
    _run(spark, tmp_dir)
    last = W.final_totals(spark, f"{tmp_dir}/stats").first()
    batch = al.rule_alerts(L)
    assert last.processed == 1000
    assert last.fraud_count == batch.count()
    alerts = spark.read.parquet(f"{tmp_dir}/alerts")
    assert alerts.count() == batch.count()
    assert alerts.select("transaction_id").distinct().count() == batch.count()


def test_rejects_and_windowed_counts(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/part-bad.txt", "w") as fh:
        fh.write("not json\n")
        fh.write('{"transaction_id": "x1", "type": "TRANSFER"}\n')
        fh.write('{"transaction_id": "x2", "timestamp": "2024-01-01T00:00:00.000000+00:00", '
                 '"type": "TRANSFER", "amount": 500000.0, "oldbalanceOrg": 500000.0, '
                 '"newbalanceOrig": 0.0, "oldbalanceDest": 0.0, "newbalanceDest": 0.0}\n')
    _run(spark, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 2
    a = spark.read.parquet(f"{tmp_dir}/alerts").collect()
    assert [r.transaction_id for r in a] == ["x2"]
    assert a[0].flags == ["Entire balance drained", "Unusually large amount",
                          "Round number amount"]
    counts = W.windowed_alert_counts(spark.read.parquet(f"{tmp_dir}/alerts"))
    assert counts.agg(F.sum("alerts")).first()[0] == 1


def test_message_encoding_round_trip(spark):
    from txnscope.schema import MESSAGE_SCHEMA
    from txnscope.sources.readers import encode_messages
    L = ledger(spark, SF_SMALL).limit(5)
    msgs = encode_messages(L).select(F.from_json("value", MESSAGE_SCHEMA).alias("m")).select("m.*")
    rows = msgs.collect()
    assert all(len(r.transaction_id) == 36 and r.timestamp.endswith("+00:00") for r in rows)
    assert encode_messages(L).select("key").distinct().count() == 5


def test_processing_time_trigger(spark, tmp_dir):
    L = ledger(spark, SF_SMALL).filter("txn_id < 200")
    W.replay_messages(L, f"{tmp_dir}/in")
    handles = W.start_consumer(spark, W.message_source(spark, f"{tmp_dir}/in"), W.rule_scorer(),
                               f"{tmp_dir}/alerts", f"{tmp_dir}/stats", f"{tmp_dir}/ckpt",
                               trigger={"processingTime": "1 second"})
    try:
        for h in handles:
            h.processAllAvailable()
    finally:
        for h in handles:
            h.stop()
    assert W.final_totals(spark, f"{tmp_dir}/stats").first().processed == 200
    assert spark.read.parquet(f"{tmp_dir}/alerts").count() == al.rule_alerts(L).count()


def test_bounded_replay_limit(spark, tmp_dir):
    W.replay_messages(ledger(spark, SF_SMALL), f"{tmp_dir}/in", limit=123)
    assert spark.read.text(f"{tmp_dir}/in").count() == 123


def test_windowed_alert_counts_as_a_stream(spark, tmp_dir):
    from txnscope.schema import ALERT_SCHEMA
    L = ledger(spark, SF_SMALL)
    W.replay_messages(L, f"{tmp_dir}/in")
    _run(spark, tmp_dir)
    alerts = spark.readStream.schema(ALERT_SCHEMA).parquet(f"{tmp_dir}/alerts")
    q = (W.windowed_alert_counts(alerts).writeStream.outputMode("complete").format("memory")
         .queryName("alert_windows").trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.sql("SELECT sum(alerts) FROM alert_windows").first()[0]
    assert total == al.rule_alerts(L).count()


def test_late_transactions_are_kept(spark, tmp_dir):
    """A transaction whose own timestamp is days older than what the stream
    has already seen is still scored and counted (nothing is dropped as late)."""
    L = ledger(spark, SF_SMALL)
    newest = L.filter("txn_id >= 900")
    oldest = L.filter("txn_id < 100")
    W.replay_messages(newest, f"{tmp_dir}/in")
    _run(spark, tmp_dir)
    W.replay_messages(oldest, f"{tmp_dir}/in")
    _run(spark, tmp_dir)
    last = W.final_totals(spark, f"{tmp_dir}/stats").first()
    assert last.processed == 200
    want = al.rule_alerts(newest.unionByName(oldest)).count()
    assert spark.read.parquet(f"{tmp_dir}/alerts").count() == want


def test_stop_mid_stream_and_restart_is_exactly_once(spark, tmp_dir):
    import time as _time
    L = ledger(spark, SF_SMALL)
    for lo in range(0, 1000, 250):                      # four input files
        W.replay_messages(L.filter(f"txn_id >= {lo} AND txn_id < {lo + 250}"), f"{tmp_dir}/in")
    src = lambda: W.message_source(spark, f"{tmp_dir}/in", max_files=1)
    handles = W.start_consumer(spark, src(), W.rule_scorer(), f"{tmp_dir}/alerts",
                               f"{tmp_dir}/stats", f"{tmp_dir}/ckpt",
                               trigger={"processingTime": "100 milliseconds"})
    deadline = _time.time() + 120
    while handles[0].lastProgress is None and _time.time() < deadline:
        _time.sleep(0.2)
    for h in handles:                                   # stop wherever the batches are
        h.stop()
    W.run_bounded(spark, src(), W.rule_scorer(), f"{tmp_dir}/alerts", f"{tmp_dir}/stats",
                  f"{tmp_dir}/ckpt")
    assert W.final_totals(spark, f"{tmp_dir}/stats").first().processed == 1000
    alerts = spark.read.parquet(f"{tmp_dir}/alerts")
    assert alerts.count() == al.rule_alerts(L).count()
    assert alerts.select("transaction_id").distinct().count() == alerts.count()


def _accounts(spark, base):
    return W.read_accounts(spark, f"{base}/stats").orderBy("epoch").collect()


def test_every_message_is_processed_rejected_or_a_duplicate(spark, tmp_dir):
    L = ledger(spark, SF_SMALL)
    W.replay_messages(L.filter("txn_id < 300"), f"{tmp_dir}/in")
    W.replay_messages(L.filter("txn_id < 200"), f"{tmp_dir}/in")           # duplicates in the same micro-batch
    _run(spark, tmp_dir)
    W.replay_messages(L.filter("txn_id >= 250 AND txn_id < 400"), f"{tmp_dir}/in")
    spark.createDataFrame([("not json",), ("",), ('{"type": "TRANSFER"}',), ("not json",)], "value string") \
        .write.mode("append").text(f"{tmp_dir}/in")
    _run(spark, tmp_dir)
    rows = _accounts(spark, tmp_dir)
    assert [(r.messages, r.processed, r.rejects, r.duplicates) for r in rows] == [(500, 300, 0, 200), (654, 400, 4, 250)]
    causes = {r.cause: r["count"] for r in spark.read.parquet(f"{tmp_dir}/rejects").groupBy("cause").count().collect()}
    assert sum(causes.values()) == 4 and causes["no transaction"] == 3
    assert any(k.startswith("missing amount") for k in causes)


def test_snapshots_hold_the_rolling_counts(spark, tmp_dir):
    L = ledger(spark, SF_SMALL)
    for lo in range(0, 1000, 250):
        W.replay_messages(L.filter(f"txn_id >= {lo} AND txn_id < {lo + 250}"), f"{tmp_dir}/in")
        _run(spark, tmp_dir)
    alerts = spark.read.parquet(f"{tmp_dir}/alerts")
    for r in _accounts(spark, tmp_dir):
        want = al.rolling_alert_counts(alerts.where(F.col("epoch") <= r.epoch), F.lit(r.recorded_at)).first()
        assert (r.last_5m, r.last_1h) == (want.last_5m, want.last_1h)


def test_old_alerts_leave_the_rolling_counts(spark, tmp_dir):
    work = W.Epochs(spark, W.rule_scorer(), f"{tmp_dir}/a", f"{tmp_dir}/s", f"{tmp_dir}/c", f"{tmp_dir}/r", "1 hour")
    L = ledger(spark, SF_SMALL)
    from txnscope.sources.readers import encode_messages
    work(encode_messages(L.filter("txn_id < 500")).select("value"), 0)
    first = work.before
    work.before = {**first, "recorded_at": first["recorded_at"] - timedelta(minutes=30),
                   "recent": [{"at": first["recorded_at"] - timedelta(minutes=70), "n": 5},
                              {"at": first["recorded_at"] - timedelta(minutes=30), "n": 7}]}
    work(encode_messages(L.filter("txn_id >= 500")).select("value"), 1)
    new = work.before["fraud_count"] - first["fraud_count"]
    assert (work.before["last_5m"], work.before["last_1h"]) == (new, new + 7)


def test_an_epoch_that_is_tried_again_is_replaced(spark, tmp_dir):
    from txnscope.sources.readers import encode_messages
    L = ledger(spark, SF_SMALL)

    def work():                                           # a restarted driver remembers nothing
        return W.Epochs(spark, W.rule_scorer(), f"{tmp_dir}/alerts", f"{tmp_dir}/stats", f"{tmp_dir}/c",
                        f"{tmp_dir}/rejects", "1 hour")
    one, two = (encode_messages(L.filter(x)).select("value") for x in ("txn_id < 600", "txn_id >= 500"))
    for epoch, batch in ((0, one), (0, one), (1, two), (1, two)):
        work()(batch, epoch)
    assert W.final_totals(spark, f"{tmp_dir}/stats").first().processed == 1000
    assert spark.read.parquet(f"{tmp_dir}/alerts").count() == al.rule_alerts(L).count()
    assert [(r.messages, r.duplicates) for r in _accounts(spark, tmp_dir)] == [(600, 0), (1100, 100)]


def test_duplicates_after_the_watermark_are_new(spark, tmp_dir):
    from txnscope.sources.readers import encode_messages
    batch = encode_messages(ledger(spark, SF_SMALL).filter("txn_id < 50")).select("value")
    work = W.Epochs(spark, W.rule_scorer(), f"{tmp_dir}/a", f"{tmp_dir}/s", f"{tmp_dir}/c", f"{tmp_dir}/r", "1 hour")
    work(batch, 0)
    work.before["recorded_at"] += timedelta(minutes=59)
    work(batch, 1)
    assert work.before["duplicates"] == 50
    work.before["recorded_at"] += timedelta(minutes=2)
    work(batch, 2)
    assert (work.before["processed"], work.before["duplicates"]) == (100, 50)


def test_messages_without_a_score_are_rejected_with_a_cause(spark, tmp_dir):
    from txnscope.sources.readers import encode_messages

    def scorer(df):
        p = F.when(F.col("amount") > 100000, F.lit(None)).otherwise(F.lit(0.9))
        return df.withColumn("p", p).withColumn("prediction", F.when(p.isNotNull(), 1))
    L = ledger(spark, SF_SMALL)
    big = L.where("amount > 100000").count()
    work = W.Epochs(spark, scorer, f"{tmp_dir}/a", f"{tmp_dir}/s", f"{tmp_dir}/c", f"{tmp_dir}/r", "1 hour")
    work(encode_messages(L).select("value"), 0)
    assert 0 < big < 1000 and work.before["rejects"] == big and work.before["processed"] == 1000 - big
    rows = spark.read.parquet(f"{tmp_dir}/r").collect()
    assert len(rows) == big and all(r.cause == "no score" and r.value for r in rows)


def test_idle_stream_still_records_snapshots(spark, tmp_dir):
    import time as _time
    W.replay_messages(ledger(spark, SF_SMALL).filter("txn_id < 100"), f"{tmp_dir}/in")
    handle, = W.start_consumer(spark, W.message_source(spark, f"{tmp_dir}/in"), W.rule_scorer(), f"{tmp_dir}/alerts",
                               f"{tmp_dir}/stats", f"{tmp_dir}/ckpt", trigger={"processingTime": "1 second"}, heartbeat=True)
    try:
        deadline = _time.time() + 120
        while (handle.lastProgress or {}).get("batchId", 0) < 3 and _time.time() < deadline:
            _time.sleep(0.5)
    finally:
        handle.stop()
    rows = _accounts(spark, tmp_dir)
    assert len(rows) >= 3 and rows[-1].processed == rows[-1].messages == 100


def test_two_hundred_epochs_leave_few_files(spark, tmp_dir):
    from txnscope.streaming.epochs import EpochTable
    table = EpochTable(spark, f"{tmp_dir}/stats", keep=40)
    start = datetime(2024, 1, 1, 22, tzinfo=timezone.utc)
    for n in range(200):
        at = start + timedelta(minutes=2 * n)
        table.write(spark.range(1).selectExpr(f"{n} AS epoch", f"{n * n} AS v").coalesce(1), n, at)
        if n % 50 == 7:                                    # tried again
            table.write(spark.range(1).selectExpr(f"{n} AS epoch", f"{n * n} AS v").coalesce(1), n, at)
        table.compact(n)
    files = [f for d, _, names in os.walk(f"{tmp_dir}/stats") for f in names if f.endswith(".parquet")]
    assert len(files) <= 40 + 2 * 2
    assert sorted((r.epoch, r.v) for r in table.read().collect()) == [(n, n * n) for n in range(200)]
    assert table.last(150).epoch == 149 and table.last(0) is None


@pytest.mark.parametrize("text, seconds", [("1 hour", 3600), ("90 seconds", 90), ("10 Minutes", 600)])
def test_spans(text, seconds):
    assert W.span(text).total_seconds() == seconds
