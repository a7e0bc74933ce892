"""Registered queries: one per operator of the inventory, each with its SQL twin.

Every query reads the test tables (through the ``ledger`` projection of
``events``) in full; none samples, caps or filters by id.  A ``None`` SQL means
the operator cannot be stated in plain SQL (learning, streaming, seeded hash
order) and is checked by row count and by the tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.functions import exact
from txnscope.functions import features as fx
from txnscope.functions import permutation
from txnscope.functions import rules
from txnscope.operators import alerts as al
from txnscope.operators import analytics as an
from txnscope.operators import metrics as me
from txnscope.plans import sqltext as Q
from txnscope.schema import DEFAULT_STREAM_LIMIT, MODEL_FEATURES
from txnscope.sources.ledger import ledger, with_ledger

Query = Callable[[SparkSession, str], DataFrame]
STATS_MINUTES = 5

_ms, _ma, _pct = exact.sql_money_sum, exact.sql_money_avg, exact.sql_pct


def _L(spark: SparkSession, sf: str) -> DataFrame:
    return ledger(spark, sf)


def _fine_amounts(spark, sf):
    """The ledger with NaN amounts in a seventh of the rows and five decimals in the others."""
    return _L(spark, sf).withColumn(
        "amount", F.when(F.col("txn_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("amount") / 1000))


def _alerts(spark, sf):
    return al.rule_alerts(_L(spark, sf))


def _stats(spark, sf):
    return al.rule_stats(_L(spark, sf), interval=f"{STATS_MINUTES} minutes")


def _scored(spark, sf):
    """Ledger scored by the rule confidence: label, score, decision."""
    return _L(spark, sf).select(F.col("isFraud").alias("label"),
                                rules.rule_confidence().alias("score")) \
        .withColumn("prediction", me.decide("score"))


ALERTS_CTE = f"alerts AS ({Q.RULE_ALERTS})"
STATS_CTE = f"stats AS ({Q.rule_stats(STATS_MINUTES)})"
SCORED_CTE = (f"scored AS (SELECT isFraud AS label, {Q.RULE_CONFIDENCE} AS score FROM ledger), "
              "decided AS (SELECT label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END "
              "AS prediction FROM scored)")


def _with(*ctes: str, body: str) -> str:
    extra = "".join(f", {x}" for x in ctes)
    return with_ledger("").rstrip("\n") + extra + "\n" + body


LEDGER_COLS = ("txn_id, ts, step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, "
               "nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud")


def _registry() -> dict[str, tuple[Query, str | None]]:
    r: dict[str, tuple[Query, str | None]] = {}

    # --- scans, counts, filters, projections ---------------------------------
    r["s7_row_counts"] = (
        lambda s, d: an.counts(_L(s, d)),
        with_ledger("SELECT count(*) AS total, count(*) FILTER (WHERE isFraud = 1) AS fraud "
                    "FROM ledger"))
    r["p1_fraud_cases"] = (
        lambda s, d: an.fraud_cases(_L(s, d)),
        with_ledger(f"SELECT {LEDGER_COLS} FROM ledger WHERE isFraud = 1"))
    r["p2_drain_transactions"] = (
        lambda s, d: an.drain_transactions(_L(s, d)),
        with_ledger(f"SELECT {', '.join(an.DRAIN_COLUMNS)} FROM ledger "
                    "WHERE newbalanceOrig = 0 AND isFraud = 1"))
    r["p2_drain_count"] = (
        lambda s, d: an.drain_transactions(_L(s, d)).agg(F.count(F.lit(1)).alias("drain_count")),
        with_ledger("SELECT count(*) AS drain_count FROM ledger "
                    "WHERE newbalanceOrig = 0 AND isFraud = 1"))
    r["p4_cleaned_export"] = (
        lambda s, d: an.cleaned_export(_L(s, d)),
        with_ledger("SELECT txn_id, ts, step, amount, oldbalanceOrg, newbalanceOrig, "
                    "oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud, "
                    f"{Q.TYPE_ENCODED} AS type_encoded FROM ledger"))
    r["p5_decode_types"] = (
        lambda s, d: an.decode_types(an.cleaned_export(_L(s, d))).select("txn_id", "type_encoded",
                                                                          "type"),
        with_ledger(f"SELECT txn_id, {Q.TYPE_ENCODED} AS type_encoded, type FROM ledger"))
    r["p6_sample_transactions"] = (
        lambda s, d: an.sample_transactions(_L(s, d), 100, only_fraud=False),
        with_ledger(f"SELECT {LEDGER_COLS} FROM ledger ORDER BY txn_id LIMIT 100"))
    r["p6_sample_fraud"] = (
        lambda s, d: an.sample_transactions(_L(s, d), 100, only_fraud=True),
        with_ledger(f"SELECT {LEDGER_COLS} FROM ledger WHERE isFraud = 1 "
                    "ORDER BY txn_id LIMIT 100"))
    r["p7_seeded_shuffle"] = (lambda s, d: an.seeded_shuffle(_L(s, d)), None)
    # W9 / P7: the bounded replay's message choice (first n in seeded-hash order).
    r["w9_bounded_replay_choice"] = (lambda s, d: an.first_n_by_hash(_L(s, d), DEFAULT_STREAM_LIMIT), None)
    # The same without a sort: a row's place in the shuffle, and the first third of the rows.
    places = permutation.permutation_sql("ledger", "txn_id - (SELECT min(txn_id) FROM ledger)", "(SELECT count(*) FROM ledger)",
                                         walks=8)
    r["p7_shuffled_places"] = (
        lambda s, d: permutation.shuffled_positions(_L(s, d)).select("txn_id", "place"),
        with_ledger(f"SELECT txn_id, place FROM ({places})"))
    r["w9_first_third_shuffled"] = (
        lambda s, d: permutation.first_n_shuffled(_L(s, d), _L(s, d).count() // 3).select(*LEDGER_COLS.split(", ")),
        with_ledger(f"SELECT {LEDGER_COLS} FROM ({places}) WHERE place < (SELECT count(*) FROM ledger) // 3"))
    r["p11_nan_to_null"] = (
        lambda s, d: an.nan_to_null(_L(s, d)),
        with_ledger(f"SELECT {LEDGER_COLS} FROM ledger"))
    # P11 on amounts that are NaN in a seventh of the rows, with digits below a cent in the others.
    fine = "CASE WHEN txn_id % 7 = 0 THEN NULL ELSE amount / 1000 END"
    r["p11_nan_amounts"] = (
        lambda s, d: an.nan_to_null(_fine_amounts(s, d)).select("txn_id", "type", "amount"),
        with_ledger(f"SELECT txn_id, type, {fine} AS amount FROM ledger"))
    r["a1_fine_amounts"] = (
        lambda s, d: an.type_stats(an.nan_to_null(_fine_amounts(s, d))).select("type", "count", "total_amount"),
        with_ledger("SELECT type, count(*) AS count, "
                    f"CAST(round(sum(CAST({fine} AS DECIMAL(38,6))), 2) AS DOUBLE) AS total_amount "
                    "FROM ledger GROUP BY type"))
    r["p12_features_and_target"] = (
        # amount_log compared at 9 places: log1p and ln(1 + x) differ in the last bit.
        lambda s, d: fx.features_and_target(_L(s, d))
        .withColumn("amount_log", F.round("amount_log", 9)),
        with_ledger(
            f"SELECT CAST({Q.TYPE_ENCODED} AS DOUBLE) AS type_encoded, amount, "
            "round(ln(1 + amount), 9) AS amount_log, oldbalanceOrg, "
            "newbalanceOrig, oldbalanceDest, newbalanceDest, "
            f"{Q.DIFF_ORIG} AS balance_diff_orig, {Q.DIFF_DEST} AS balance_diff_dest, "
            "oldbalanceOrg - amount - newbalanceOrig AS error_balance_orig, "
            "oldbalanceDest + amount - newbalanceDest AS error_balance_dest, isFraud "
            "FROM ledger"))

    # --- aggregations ------------------------------------------------------------
    r["a1_type_stats"] = (
        lambda s, d: an.type_stats(_L(s, d)),
        with_ledger(
            f"SELECT type, count(*) AS count, {_ms('amount')} AS total_amount, "
            f"{_ma('amount')} AS avg_amount, round(min(amount), 2) AS min_amount, "
            "round(max(amount), 2) AS max_amount, CAST(sum(isFraud) AS BIGINT) AS fraud_count, "
            f"{_pct('sum(isFraud)', 'count(*)', 4)} AS fraud_percentage "
            "FROM ledger GROUP BY type ORDER BY type"))
    r["a2_transaction_summary"] = (
        lambda s, d: an.transaction_summary(_L(s, d)),
        with_ledger(
            "SELECT type, count(*) AS total_count, CAST(sum(isFraud) AS BIGINT) AS fraud_count, "
            f"{_pct('sum(isFraud)', 'count(*)', 4)} AS fraud_rate, "
            f"{_ma('amount')} AS avg_amount, max(amount) AS max_amount "
            "FROM ledger GROUP BY type ORDER BY type"))
    r["a3_hourly_pattern"] = (
        lambda s, d: an.hourly_pattern(_L(s, d)),
        with_ledger(
            "").rstrip("\n") + ", h AS (SELECT step, count(*) AS total_transactions, "
        "CAST(sum(isFraud) AS BIGINT) AS fraud_count, "
        f"{_pct('sum(isFraud)', 'count(*)', 4)} AS fraud_rate FROM ledger GROUP BY step)\n"
        "SELECT step, total_transactions, fraud_count, fraud_rate, "
        "coalesce(fraud_rate >= (SELECT quantile_cont(fraud_rate, 0.9) FROM h), false) "
        "AS is_peak_fraud_hour FROM h ORDER BY step")
    r["a4_fraud_over_time"] = (
        lambda s, d: an.fraud_over_time(_L(s, d)),
        with_ledger("SELECT step, count(*) AS fraud_count FROM ledger WHERE isFraud = 1 "
                    "GROUP BY step ORDER BY step"))
    r["a5_fraud_by_type"] = (
        lambda s, d: an.fraud_by_type(_L(s, d)),
        with_ledger("SELECT type, count(*) AS total, CAST(sum(isFraud) AS BIGINT) AS fraud_count, "
                    f"{_pct('sum(isFraud)', 'count(*)', 2)} AS \"fraud_rate_%\" "
                    "FROM ledger GROUP BY type ORDER BY fraud_count DESC, type"))
    r["a6_amount_by_label"] = (
        lambda s, d: an.amount_by_label(_L(s, d)),
        with_ledger(f"SELECT {Q.fraud_label('isFraud', 'Legit')} AS isFraud, "
                    f"{exact.sql_exact_mean('amount', exact.MONEY_SCALE, 6)} AS avg_amount, count(*) AS count "
                    "FROM ledger GROUP BY ledger.isFraud"))
    bucket_case = ("CASE WHEN amount < 1000 THEN '{0}' WHEN amount < 10000 THEN '{1}' "
                   "WHEN amount < 100000 THEN '{2}' WHEN amount < 500000 THEN '{3}' "
                   "ELSE '{4}' END")
    labels = [b[1] for b in an.AMOUNT_BUCKETS]
    r["a7_amount_distribution"] = (
        lambda s, d: an.amount_distribution(_L(s, d)),
        with_ledger(
            f"SELECT {bucket_case.format(*labels)} AS amount_bucket, "
            f"{bucket_case.format(0, 1, 2, 3, 4).replace(chr(39), '')} AS bucket_ord, "
            f"count(*) AS count, {Q.fraud_label()} AS label "
            "FROM ledger GROUP BY 1, 2, isFraud ORDER BY bucket_ord, label"))
    r["a8_kpis"] = (
        lambda s, d: an.kpis(_L(s, d)),
        with_ledger(
            "SELECT total, fraud, total - fraud AS legit, fraud_amount_lost, "
            f"{_pct('fraud', 'total', 4)} AS fraud_rate FROM ("
            "SELECT count(*) AS total, count(*) FILTER (WHERE isFraud = 1) AS fraud, "
            f"coalesce({_ms('CASE WHEN isFraud = 1 THEN amount END')}, 0.0) AS fraud_amount_lost "
            "FROM ledger) k"))
    r["a15_class_balance"] = (
        lambda s, d: an.class_balance(_L(s, d)),
        with_ledger("SELECT isFraud, count(*) AS count FROM ledger GROUP BY isFraud "
                    "ORDER BY isFraud"))

    # --- top-k -------------------------------------------------------------------
    r["t1_high_risk_senders"] = (
        lambda s, d: an.high_risk_senders(_L(s, d), 50),
        with_ledger(
            f"SELECT nameOrig, count(*) AS fraud_count, {_ms('amount')} AS total_fraud_amount, "
            f"{_ma('amount')} AS avg_fraud_amount FROM ledger WHERE isFraud = 1 "
            "GROUP BY nameOrig ORDER BY fraud_count DESC, total_fraud_amount DESC, nameOrig "
            "LIMIT 50"))
    r["t2_top_fraud_senders"] = (
        lambda s, d: an.top_fraud_senders(_L(s, d), 10),
        with_ledger(
            f"SELECT nameOrig, count(*) AS fraud_count, {_ms('amount')} AS total_amount "
            "FROM ledger WHERE isFraud = 1 GROUP BY nameOrig "
            "ORDER BY fraud_count DESC, total_amount DESC, nameOrig LIMIT 10"))
    r["t3_largest_frauds"] = (
        lambda s, d: an.largest_frauds(_L(s, d), 10),
        with_ledger("SELECT txn_id, step, type, amount, nameOrig FROM ledger WHERE isFraud = 1 "
                    "ORDER BY amount DESC, txn_id LIMIT 10"))
    r["t5_types_by_fraud_rate"] = (
        lambda s, d: an.types_by_fraud_rate(an.transaction_summary(_L(s, d))),
        "SELECT *, row_number() OVER (ORDER BY fraud_rate DESC, type) AS fraud_rank FROM ("
        + r["a2_transaction_summary"][1] + ") s")
    r["r1_safe_vs_fraud_long"] = (
        lambda s, d: an.safe_vs_fraud_long(an.transaction_summary(_L(s, d))),
        with_ledger(
            "SELECT type AS Type, count(*) - CAST(sum(isFraud) AS BIGINT) AS Count, "
            "'Safe' AS Category FROM ledger GROUP BY type UNION ALL "
            "SELECT type AS Type, CAST(sum(isFraud) AS BIGINT) AS Count, 'Fraud' AS Category "
            "FROM ledger GROUP BY type"))

    # --- features and rules ---------------------------------------------------
    r["f10_model_features"] = (
        lambda s, d: fx.model_matrix(_L(s, d), keep=["txn_id", "isFraud"]),
        with_ledger(
            f"SELECT txn_id, isFraud, CAST({Q.TYPE_ENCODED} AS DOUBLE) AS type_encoded, amount, "
            "oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, "
            f"{Q.DIFF_ORIG} AS balance_diff_orig, {Q.DIFF_DEST} AS balance_diff_dest, "
            f"{Q.RATIO} AS amount_to_balance_ratio, "
            f"CAST({Q.IS_ROUND} AS DOUBLE) AS is_round_amount, "
            f"CAST({Q.ZERO_ORIG} AS DOUBLE) AS zero_orig_balance FROM ledger"))
    r["f11_flags"] = (
        lambda s, d: _L(s, d).select("txn_id", rules.flags_text(rules.flags(), "").alias("flags")),
        with_ledger(f"SELECT txn_id, {Q.flags_text(Q.FLAGS, '')} AS flags FROM ledger"))
    r["f12_risk_levels"] = (
        lambda s, d: _L(s, d).select("txn_id", rules.rule_confidence().alias("confidence"))
        .select("txn_id", "confidence", rules.risk_level("confidence").alias("risk_level"),
                rules.prediction_label(me.decide("confidence")).alias("label")),
        with_ledger(
            f"SELECT txn_id, confidence, {Q.risk_level('confidence')} AS risk_level, "
            "CASE WHEN confidence >= 0.5 THEN 'FRAUD' ELSE 'LEGITIMATE' END AS label "
            f"FROM (SELECT txn_id, {Q.RULE_CONFIDENCE} AS confidence FROM ledger) s"))
    r["f15_risk_factors"] = (
        lambda s, d: _L(s, d).select("txn_id", F.posexplode(rules.factor_array()))
        .select("txn_id", F.col("pos").alias("factor_ord"), F.col("col.factor").alias("factor"),
                F.col("col.score").alias("score"),
                rules.factor_band(F.col("col.score")).alias("band")),
        with_ledger(" UNION ALL ".join(
            f"SELECT txn_id, {i} AS factor_ord, '{name}' AS factor, {expr} AS score, "
            f"CASE WHEN {expr} >= 60 THEN 'high' WHEN {expr} >= 30 THEN 'medium' "
            "ELSE 'low' END AS band FROM ledger"
            for i, (name, expr) in enumerate(zip(rules.FACTOR_NAMES, Q.FACTORS)))))
    r["f18_time_text"] = (
        lambda s, d: _L(s, d).select(
            "txn_id", fx.file_stamp(F.col("ts")).alias("stamp"),
            fx.display_time(F.col("ts")).alias("display"),
            fx.parse_iso(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
            .alias("parsed")),
        with_ledger("SELECT txn_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, "
                    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS display, ts AS parsed FROM ledger"))
    r["f20_text_fields"] = (
        lambda s, d: _L(s, d).select("txn_id", fx.short_id("nameOrig").alias("short_id"),
                                     fx.money_text("amount", 0).alias("amount_text"),
                                     fx.money2("amount").alias("amount_2dp")),
        with_ledger("SELECT txn_id, substring(nameOrig, 1, 8) AS short_id, "
                    "format('{:,.0f}', amount) AS amount_text, round(amount, 2) AS amount_2dp "
                    "FROM ledger"))
    r["f21_amount_p90"] = (
        lambda s, d: me.exact_percentile(_L(s, d), "amount", 0.9, "p90_amount"),
        with_ledger("SELECT quantile_cont(amount, 0.9) AS p90_amount FROM ledger"))

    # --- alert and stats tables ----------------------------------------------------
    r["k7_rule_alerts"] = (
        lambda s, d: _alerts(s, d).withColumn("flags", F.array_join("flags", "|")),
        _with(ALERTS_CTE, body="SELECT transaction_id, type, amount, confidence, risk_level, "
              "array_to_string(flags, '|') AS flags, timestamp, nameOrig, nameDest, saved_at "
              "FROM alerts"))
    r["k8_rule_stats"] = (_stats, _with(STATS_CTE, body="SELECT * FROM stats"))
    r["a9_alert_amount_stats"] = (
        lambda s, d: al.alert_amount_stats(_alerts(s, d)),
        _with(ALERTS_CTE, body=f"SELECT {_ms('amount')} AS total_amount, "
              f"{exact.sql_exact_mean('confidence', 4, 6)} AS avg_conf, "
              "max(confidence) AS max_conf, min(confidence) AS min_conf FROM alerts"))
    r["a10_alerts_by_risk"] = (
        lambda s, d: al.alerts_by(_alerts(s, d), "risk_level"),
        _with(ALERTS_CTE, body="SELECT risk_level, count(*) AS count FROM alerts "
              "GROUP BY risk_level ORDER BY count DESC, risk_level"))
    r["a11_alerts_by_type"] = (
        lambda s, d: al.alerts_by(_alerts(s, d), "type"),
        _with(ALERTS_CTE, body="SELECT type, count(*) AS count FROM alerts "
              "GROUP BY type ORDER BY count DESC, type"))
    r["a12_table_inventory"] = (
        lambda s, d: al.table_inventory({
            "transactions": _L(s, d), "fraud_cases": an.fraud_cases(_L(s, d)),
            "live_fraud_alerts": _alerts(s, d), "live_stats": _stats(s, d)}),
        _with(ALERTS_CTE, STATS_CTE, body=(
            "SELECT 'transactions' AS table_name, count(*) AS rows FROM ledger UNION ALL "
            "SELECT 'fraud_cases', count(*) FROM ledger WHERE isFraud = 1 UNION ALL "
            "SELECT 'live_fraud_alerts', count(*) FROM alerts UNION ALL "
            "SELECT 'live_stats', count(*) FROM stats")))
    r["a12_dataset_fraud_rate"] = (
        lambda s, d: al.dataset_fraud_rate(_L(s, d)),
        with_ledger("SELECT total, fraud, " + _pct("fraud", "total", 4) + " AS fraud_rate FROM "
                    "(SELECT count(*) AS total, count(*) FILTER (WHERE isFraud = 1) AS fraud "
                    "FROM ledger) k"))
    r["a13_first_and_latest"] = (
        lambda s, d: al.first_and_latest(_stats(s, d)),
        _with(STATS_CTE, body=(
            "SELECT arg_min(processed, recorded_at) AS first_processed, "
            "min(recorded_at) AS first_recorded_at, "
            "arg_max(processed, recorded_at) AS latest_processed, "
            "arg_max(fraud_count, recorded_at) AS latest_fraud_count, "
            "arg_max(fraud_rate, recorded_at) AS latest_fraud_rate, "
            "arg_max(avg_confidence, recorded_at) AS latest_avg_confidence, "
            "max(recorded_at) AS latest_recorded_at FROM stats")))
    r["a14_throughput"] = (
        lambda s, d: al.throughput(_stats(s, d)),
        _with(STATS_CTE, body=(
            "SELECT processed, elapsed_sec, rate, CASE WHEN rate <> 0 THEN "
            f"{float(al.ETA_BACKLOG)} / rate / 3600 ELSE {float(al.ETA_NO_RATE)} END AS eta_hours "
            "FROM (SELECT processed, elapsed_sec, CASE WHEN elapsed_sec <> 0 THEN "
            "processed / elapsed_sec ELSE 0.0 END AS rate FROM ("
            "SELECT arg_max(processed, recorded_at) AS processed, "
            "(epoch_us(max(recorded_at)) - epoch_us(min(recorded_at))) / 1e6 AS elapsed_sec "
            "FROM stats) a) b")))
    r["a16_rolling_alert_counts"] = (
        lambda s, d: al.rolling_alert_counts(_alerts(s, d)),
        _with(ALERTS_CTE, body=(
            "SELECT count(*) FILTER (WHERE saved_at >= m - INTERVAL 5 MINUTES) AS last_5m, "
            "count(*) FILTER (WHERE saved_at >= m - INTERVAL 1 HOUR) AS last_1h, "
            "count(*) AS total FROM alerts, (SELECT max(saved_at) AS m FROM alerts) mx")))
    r["p8_alerts_last_hour"] = (
        lambda s, d: al.since(_alerts(s, d), "saved_at", "1 HOUR")
        .withColumn("flags", F.array_join("flags", "|")),
        _with(ALERTS_CTE, body=(
            "SELECT transaction_id, type, amount, confidence, risk_level, "
            "array_to_string(flags, '|') AS flags, timestamp, nameOrig, nameDest, saved_at "
            "FROM alerts WHERE saved_at >= (SELECT max(saved_at) FROM alerts) - INTERVAL 1 HOUR")))
    r["a17_recent_stats_series"] = (
        lambda s, d: al.recent_stats_series(_stats(s, d), 30),
        _with(STATS_CTE, body=(
            "SELECT recorded_at, fraud_count FROM stats WHERE recorded_at >= "
            "(SELECT max(recorded_at) FROM stats) - INTERVAL 30 MINUTES ORDER BY recorded_at")))
    r["t4_latest_alerts"] = (
        lambda s, d: al.alert_cards(_alerts(s, d), 12),
        _with(ALERTS_CTE, body=(
            "SELECT substring(transaction_id, 1, 8) AS short_id, "
            "strftime(saved_at, '%Y-%m-%d %H:%M:%S') AS saved_at_text, type, amount, risk_level, "
            f"{Q.flags_text('flags')} AS flags_text, "
            "round(confidence * 100, 1) AS confidence_pct FROM alerts "
            "ORDER BY saved_at DESC, transaction_id DESC LIMIT 12")))

    # F21 approximate: daily sketches stored once, merged over all days; ranks of the answers against all amounts.
    def sketched(s, d):
        from txnscope.session import materialize
        days = materialize(me.quantile_sketches(_L(s, d).withColumn("day", F.to_date("ts")), ["day"], "amount"), "day-sketches")
        probs = [0.1, 0.5, 0.9, 0.99]
        q = me.sketch_quantiles(days, probs)
        ranks = [(F.abs(F.count_if(F.col("amount") <= F.col(f"q{round(p * 100)}")) / F.count("*") - p) <= me.SKETCH_RANK_ERROR
                  + F.max("share")).alias(f"q{round(p * 100)}_within") for p in probs]
        # A value that many rows share spans ranks; its own share comes on top of the sketch's error.
        shares = _L(s, d).groupBy("amount").agg(F.count("*").alias("m")).agg(F.max("m").alias("m"))
        rows = _L(s, d).select("amount").join(F.broadcast(q)).join(F.broadcast(shares)).withColumn("share", F.col("m") / F.col("n"))
        return rows.agg(F.first("n").alias("n"), *ranks)
    r["f21_sketched_quantiles"] = (sketched, with_ledger(
        "SELECT count(amount) AS n, true AS q10_within, true AS q50_within, true AS q90_within, true AS q99_within FROM ledger"))

    # --- metrics on the rule score -------------------------------------------------
    r["m7_classification_metrics"] = (
        lambda s, d: me.classification_metrics(_scored(s, d)),
        _with(SCORED_CTE, body=(
            "SELECT tn, fp, fn, tp, accuracy, precision, recall, "
            "CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
            "ELSE 0.0 END AS f1_score FROM (SELECT tn, fp, fn, tp, "
            "CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END "
            "AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, "
            "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM ("
            "SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
            "count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
            "count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, "
            "count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM decided) c) m")))
    r["m8_confusion_cells"] = (
        lambda s, d: _scored(s, d).groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("count")),
        _with(SCORED_CTE, body="SELECT label, prediction, count(*) AS count FROM decided "
              "GROUP BY label, prediction"))
    r["m8_per_class_report"] = (
        lambda s, d: me.per_class_report(_scored(s, d)),
        _with(SCORED_CTE, body=(
            'SELECT class, class_name, "precision", "recall", CASE WHEN "precision" + "recall" > 0 '
            'THEN 2 * "precision" * "recall" / ("precision" + "recall") ELSE 0.0 END AS f1_score, support FROM ('
            "SELECT k AS class, CASE WHEN k = 1 THEN 'Fraud' ELSE 'Legit' END AS class_name, "
            "CASE WHEN count(*) FILTER (WHERE prediction = k) > 0 THEN count(*) FILTER (WHERE label = k AND "
            "prediction = k) / count(*) FILTER (WHERE prediction = k) ELSE 0.0 END AS \"precision\", "
            "CASE WHEN count(*) FILTER (WHERE label = k) > 0 THEN count(*) FILTER (WHERE label = k AND "
            "prediction = k) / count(*) FILTER (WHERE label = k) ELSE 0.0 END AS \"recall\", "
            "count(*) FILTER (WHERE label = k) AS support "
            "FROM decided, (VALUES (0), (1)) v(k) GROUP BY k) x")))

    def at_thresholds(s, d):
        rows = _scored(s, d).withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in (0.3, 0.5, 0.7)])))
        return rows.withColumn("prediction", me.decide("score", F.col("threshold"))).groupBy("threshold").agg(
            F.sum("prediction").alias("flagged"), F.sum(F.col("prediction") * F.col("label")).alias("caught"))
    r["m12_threshold_sweep"] = (at_thresholds, _with(SCORED_CTE, body=(
        "SELECT threshold, count(*) FILTER (WHERE score >= threshold) AS flagged, "
        "count(*) FILTER (WHERE score >= threshold AND label = 1) AS caught FROM scored, "
        "(VALUES (CAST(0.3 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(0.7 AS DOUBLE))) v(threshold) "
        "GROUP BY threshold")))
    r["m9_roc_auc"] = (
        lambda s, d: me.roc_auc(_scored(s, d)),
        _with(SCORED_CTE, body=(
            "SELECT CASE WHEN P > 0 AND N > 0 THEN CAST(num2 AS DOUBLE) / (2.0 * CAST(P AS DOUBLE) "
            "* CAST(N AS DOUBLE)) END AS roc_auc FROM (SELECT "
            "sum(CAST(pos AS HUGEINT) * (2 * (tn - cum_neg) + neg)) AS num2, "
            "max(tp) AS P, max(tn) AS N FROM (SELECT score, pos, neg, "
            "sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg, "
            "sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM ("
            "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, "
            "count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score) g) w) a")))
    r["m10_roc_curve"] = (
        lambda s, d: me.roc_curve(_scored(s, d)),
        _with(SCORED_CTE, body=(
            "SELECT 'inf'::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL "
            "SELECT score AS threshold, CASE WHEN tn > 0 THEN cum_neg / CAST(tn AS DOUBLE) "
            "ELSE 0.0 END AS fpr, CASE WHEN tp > 0 THEN cum_pos / CAST(tp AS DOUBLE) ELSE 0.0 END "
            "AS tpr FROM (SELECT score, pos, neg, "
            "sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos, "
            "sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg, "
            "row_number() OVER (ORDER BY score DESC) AS rn, "
            "lead(pos) OVER (ORDER BY score DESC) AS next_pos, "
            "lead(neg) OVER (ORDER BY score DESC) AS next_neg, "
            "sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM ("
            "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, "
            "count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score) g) w "
            "WHERE next_pos IS NULL OR rn = 1 OR next_pos <> pos OR next_neg <> neg")))
    r["m11_average_precision"] = (
        lambda s, d: me.average_precision(_scored(s, d)),
        _with(SCORED_CTE, body=(
            "SELECT CASE WHEN P > 0 THEN round(s / P, 10) ELSE 0.0 END AS average_precision FROM ("
            "SELECT sum(pos * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) AS s, "
            "CAST(max(tp) AS DOUBLE) AS P FROM (SELECT score, pos, "
            "sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos, "
            "sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg, "
            "sum(pos) OVER () AS tp FROM ("
            "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, "
            "count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score) g) w) a")))
    _add_stored(r)
    _add_learning(r)
    _add_streaming(r)
    return r


# --- write, then read back: sources and sinks over the whole ledger -----------------
def _add_stored(r: dict) -> None:
    import uuid

    from txnscope.plans import batch_job
    from txnscope.schema import TXN_COLUMNS
    from txnscope.session import scratch_path
    from txnscope.sources import readers as R

    def folder(s):
        return scratch_path(s, f"stored-{uuid.uuid4().hex}")

    def as_csv(s, d):
        path = f"{folder(s)}/csv"
        # The file's columns stand in another order than the declared ones.
        _L(s, d).select(*reversed(TXN_COLUMNS)).write.option("header", True).csv(path)
        return path

    cols = ", ".join(TXN_COLUMNS)
    r["s1_typed_csv"] = (lambda s, d: R.read_transactions_csv(s, as_csv(s, d)),
                         with_ledger(f"SELECT {cols} FROM ledger"))
    r["s2_inferred_csv_types"] = (
        lambda s, d: R.load_raw(s, as_csv(s, d)).groupBy("type").agg(
            F.count("*").alias("n"), F.max("amount").alias("max_amount")),
        with_ledger("SELECT type, count(*) AS n, max(amount) AS max_amount FROM ledger GROUP BY type"))

    def collection(s, d):
        path = f"{folder(s)}/collection"
        R.write_table(_L(s, d).withColumn("_id", F.col("txn_id")), path)
        return R.read_collection(s, "", fmt="parquet", options={"path": path}).select(*TXN_COLUMNS)
    r["s4_read_collection"] = (collection, with_ledger(f"SELECT {cols} FROM ledger"))

    def loaded(s, d):
        base = folder(s)
        R.load_transactions(s, as_csv(s, d), f"{base}/transactions", f"{base}/fraud", f"{base}/staging")
        # The second load finds rows and adds none.
        R.load_transactions(s, as_csv(s, d), f"{base}/transactions", f"{base}/fraud", f"{base}/staging-2")
        rows = s.read.parquet(f"{base}/transactions")
        return rows.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("txn_id").alias("n_ids"),
                                        F.max("amount").alias("max_amount"))
    r["k3_loaded_by_type"] = (loaded, with_ledger(
        "SELECT type, count(*) AS n, count(*) AS n_ids, max(amount) AS max_amount FROM ledger GROUP BY type"))

    def documents(s, d):
        path = f"{folder(s)}/documents"
        R.write_documents(_L(s, d), path)
        fields = T.StructType([f for f in _L(s, d).schema.fields if f.name in ("txn_id", "type", "amount", "isFraud", "ts")])
        return R.read_documents(s, path, fields, where={"type": "TRANSFER"})
    r["s4_exported_documents"] = (documents, with_ledger(
        "SELECT txn_id, ts, type, amount, isFraud FROM ledger WHERE type = 'TRANSFER'"))

    def reject_reasons(s, d):
        """A file with wrong fields of several kinds among its rows; how often each set of reasons is given."""
        base, kind = folder(s), F.col("txn_id") % 40
        text = {n: F.col(n).cast("string") for n in TXN_COLUMNS}
        text["amount"] = F.when(kind.isin(0, 3), F.lit("n/a")).otherwise(text["amount"])
        text["step"] = F.when(kind.isin(1, 3), F.lit("1.5h")).otherwise(text["step"])
        text["isFraud"] = F.when(kind == 2, F.lit("yes")).otherwise(text["isFraud"])
        text["newbalanceOrig"] = F.when(kind == 4, F.lit("1,000.50")).otherwise(text["newbalanceOrig"])
        text["oldbalanceDest"] = F.when(kind != 5, text["oldbalanceDest"])
        _L(s, d).select(*[v.alias(n) for n, v in text.items()]).write.option("header", True).csv(f"{base}/csv")
        out = R.load_transactions(s, f"{base}/csv", f"{base}/transactions", f"{base}/fraud", f"{base}/staging", f"{base}/rejects",
                                  summary=f"{base}/summary")
        kept = s.read.parquet(f"{base}/summary").agg(F.lit("accepted").alias("reasons"), F.sum("total_count").alias("n"))
        return s.read.parquet(f"{base}/rejects").groupBy(F.array_join("reasons", "; ").alias("reasons")) \
            .agg(F.count("*").alias("n")).unionByName(kept) if out["rejected"] else kept
    r["k4_reject_reasons"] = (reject_reasons, with_ledger(
        "SELECT CASE txn_id % 40 WHEN 0 THEN 'amount is no double: n/a' WHEN 1 THEN 'step is no int: 1.5h' "
        "WHEN 2 THEN 'isFraud is no int: yes' WHEN 3 THEN 'step is no int: 1.5h; amount is no double: n/a' "
        "WHEN 4 THEN 'newbalanceOrig is no double: 1,000.50' ELSE 'accepted' END AS reasons, count(*) AS n "
        "FROM ledger GROUP BY 1"))

    def result_table(name):
        def run(s, d):
            out = batch_job.run_analyses(s, _L(s, d), folder(s), export=name == "cleaned")
            return R.load_processed(s, out[name])
        return run
    r["k1_stored_type_stats"] = (result_table("spark_type_stats"), r["a1_type_stats"][1])
    r["k2_stored_export"] = (result_table("cleaned"), r["p4_cleaned_export"][1])
    r["k5_stored_summary"] = (result_table("transaction_summary"), r["a2_transaction_summary"][1])


# --- learning (no SQL twin: hash split, resampling, fitted models) -------------------
def _resampled(spark, sf):
    from txnscope.learning import models as M
    from txnscope.learning.smote import smote
    from txnscope.learning.split import stratified_split
    from txnscope.session import materialize
    train, test = stratified_split(M.prepare(_L(spark, sf)))
    return materialize(smote(train, MODEL_FEATURES), "resampled"), test


#: Test rows by largest remainder: t in all, t1 of them fraud.
SPLIT_CTES = (
    "n AS (SELECT count(*) AS n, count(*) FILTER (WHERE isFraud = 1) AS n1, "
    "count(*) FILTER (WHERE isFraud = 0) AS n0 FROM ledger)",
    "draws AS (SELECT *, CAST(ceil(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS t FROM n)",
    "sides AS (SELECT *, (t * n1) // n + CASE WHEN (t * n1) % n > (t * n0) % n THEN 1 ELSE 0 END AS t1 FROM draws)")


def _add_learning(r: dict) -> None:
    from pyspark.ml.functions import vector_to_array

    from txnscope.learning import models as M
    from txnscope.learning.split import test_predicate

    def split_sides(s, d):
        L = _L(s, d)
        side = F.coalesce(test_predicate(L), F.lit(False))
        return L.select("txn_id", "isFraud",
                        F.when(side, "test").otherwise("train").alias("side"))
    r["m1_split_sides"] = (split_sides, None)
    r["m1_split_counts"] = (
        lambda s, d: split_sides(s, d).groupBy("isFraud", "side").agg(F.count("*").alias("n")),
        _with(*SPLIT_CTES, body=(
            "SELECT 1 AS isFraud, 'test' AS side, t1 AS n FROM sides UNION ALL "
            "SELECT 1, 'train', n1 - t1 FROM sides UNION ALL SELECT 0, 'test', t - t1 FROM sides UNION ALL "
            "SELECT 0, 'train', n0 - (t - t1) FROM sides")))
    r["m2_class_counts"] = (
        lambda s, d: _resampled(s, d)[0].groupBy("isFraud").agg(F.count("*").alias("n")),
        _with(*SPLIT_CTES, body=(
            "SELECT 0 AS isFraud, n0 - (t - t1) AS n FROM sides UNION ALL SELECT 1, "
            "greatest(n1 - t1, CAST(floor(CAST(0.1 AS DOUBLE) * (n0 - (t - t1))) AS BIGINT)) FROM sides")))
    r["m2_smote_training_set"] = (lambda s, d: _resampled(s, d)[0], None)

    def scaled(s, d):
        from pyspark.ml.feature import StandardScaler, VectorAssembler
        train, test = _resampled(s, d)
        va = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="raw", handleInvalid="skip")
        sc = StandardScaler(inputCol="raw", outputCol="z", withMean=True, withStd=True) \
            .fit(va.transform(train))
        return sc.transform(va.transform(test)).select(
            "txn_id", "isFraud", vector_to_array("z").alias("scaled"))
    r["m3_scaled_test_features"] = (scaled, None)

    def batch_scores(s, d):
        train, _ = _resampled(s, d)
        n = train.count()
        lr = M.pipeline(M.classifier("Logistic Regression", M.ModelSpec(), n)) \
            .fit(M.with_weights(train))
        return M.score_transactions(lr, _L(s, d)).select(
            "txn_id", "type", "amount", "prediction", "label", "confidence", "risk_level",
            F.array_join("flags", "|").alias("flags"))
    r["m15_batch_scores"] = (batch_scores, None)
    # Every row comes back; the reason is checked against SQL on null, NaN and zero-denominator inputs.
    def score_reasons(s, d):
        train, _ = _resampled(s, d)
        lr = M.pipeline(M.classifier("Logistic Regression", M.ModelSpec(), train.count())) \
            .fit(M.with_weights(train))
        kind = F.col("txn_id") % 5
        rows = _L(s, d).withColumn("amount", F.when(kind == 0, F.lit(None).cast("double"))
                                   .when(kind == 1, F.lit(float("nan"))).otherwise(F.col("amount"))) \
            .withColumn("oldbalanceOrg", F.when(kind == 2, F.lit(-1.0)).otherwise(F.col("oldbalanceOrg")))
        return M.batch_score(lr, rows).select(
            "txn_id", F.col("prediction").isNotNull().alias("scored"),
            F.coalesce(F.col("score_error").contains("amount"), F.lit(False)).alias("names_amount"))
    r["m15_score_reasons"] = (score_reasons, with_ledger(
        "SELECT txn_id, txn_id % 5 > 2 AS scored, txn_id % 5 <= 2 AS names_amount FROM ledger"))
    # One level of second-order boosting: the root's histograms at fixed cuts, in units of 2^-20.
    cuts = {"amount": [1000.0, 10000.0, 50000.0, 100000.0], "oldbalanceOrg": [0.0, 1000.0, 100000.0]}

    def first_level(s, d):
        from txnscope.learning import boosting as B
        rows = B.binned(_L(s, d), list(cuts), list(cuts.values()), "isFraud", 99.0)
        root = {"feature": [-1], "bin": [0], "left": [-1], "gain": [0.0], "weight": [0.0]}
        return B.level_sums(rows, len(cuts), [], root, [0], 20)
    per_feature = " UNION ALL ".join(
        f"SELECT {i} AS feature, {' + '.join(f'CASE WHEN {f} > {e} THEN 1 ELSE 0 END' for e in edges)} AS bin, isFraud FROM ledger"
        for i, (f, edges) in enumerate(cuts.items()))
    r["m5_first_level_sums"] = (first_level, with_ledger(
        "SELECT 0 AS node, feature, bin, count(*) AS n, "
        "CAST(sum(CASE WHEN isFraud = 1 THEN -99 ELSE 1 END) * 524288 AS BIGINT) AS g, "
        f"CAST(sum(CASE WHEN isFraud = 1 THEN 99 ELSE 1 END) * 262144 AS BIGINT) AS h FROM ({per_feature}) GROUP BY feature, bin"))
    # The reduced curves of a report against the full ones: how many points, and whether the areas agree.
    def report_curves(s, d):
        got, run = me.curve_summary(_scored(s, d))
        points = list(zip(got["fpr"], got["tpr"]))
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        return run.agg(F.max("tot_pos").alias("positives"), F.max("tot_neg").alias("negatives")).select(
            "positives", "negatives", F.lit(abs(area - got["roc_auc"]) < 1 / (4 * me.CURVE_CELLS)).alias("area_within_bound"),
            F.lit(len(points) <= 4 * me.CURVE_CELLS + 3).alias("points_within_bound"),
            F.lit(round(got["roc_auc"], 9)).alias("roc_auc"))
    r["k9_report_curves"] = (report_curves, _with(SCORED_CTE, body=(
        "SELECT P AS positives, N AS negatives, true AS area_within_bound, true AS points_within_bound, round(num2 / (2.0 * P * N), 9) "
        "AS roc_auc FROM (SELECT sum(pos)::BIGINT AS P, sum(neg)::BIGINT AS N, sum(pos * (2 * (tn - cum_neg) + neg))::DOUBLE AS num2 "
        "FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg, sum(neg) OVER () AS tn "
        "FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM scored "
        "GROUP BY score) g) w) a")))

    def boosted_scores(s, d):
        from txnscope.learning import boosting as B
        from txnscope.learning.split import stratified_split
        train, _ = stratified_split(M.prepare(_L(s, d)))
        model = B.fit(train, spec=B.BoostSpec(rounds=10, depth=4))
        return model.score(M.prepare(_L(s, d))).select(
            "txn_id", F.col("score").isNotNull().alias("scored"), F.col("score").between(0, 1).alias("is_probability"))
    r["m5_boosted_scores"] = (boosted_scores, with_ledger(
        "SELECT txn_id, true AS scored, true AS is_probability FROM ledger"))

    def tree_scores(s, d):
        """Batch scoring of a forest by leaf tables against its fitted stages, row by row."""
        train, _ = _resampled(s, d)
        model = M.pipeline(M.classifier("Random Forest", M.ModelSpec(rf_trees=20, rf_depth=8), train.count())) \
            .fit(M.with_weights(train))
        own = M.scored_features(model, _L(s, d)).select("txn_id", "score", "prediction")
        stages = M.probability_of_fraud(model.transform(M.prepare(_L(s, d)))).select(
            "txn_id", F.col("score").alias("p"), F.col("prediction").cast("int").alias("decided"))
        return own.join(stages, "txn_id").select("txn_id", (F.abs(F.col("score") - F.col("p")) < 1e-12).alias("same_score"),
                                                 (F.col("prediction") == F.col("decided")).alias("same_prediction"))
    r["m15_tree_scores"] = (tree_scores, with_ledger("SELECT txn_id, true AS same_score, true AS same_prediction FROM ledger"))
    r["m17_model_comparison"] = (
        lambda s, d: M.metric_table(M.compare_models(_L(s, d)).report), None)


# --- streaming: bounded replays of the ledger through the consumer ------------------
def _stream_run(spark, sf, scorer=None):
    """Two runs over one checkpoint: all transactions, then replays of a third of them and messages without an amount."""
    import uuid

    from txnscope.session import scratch_path
    from txnscope.streaming import consumer as W
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")

    def run():
        W.run_bounded(spark, W.message_source(spark, f"{base}/in"), scorer or W.rule_scorer(),
                      f"{base}/alerts", f"{base}/stats", f"{base}/ckpt", f"{base}/rejects")
    W.replay_messages(_L(spark, sf), f"{base}/in")
    run()
    W.replay_messages(_L(spark, sf).where("txn_id % 3 = 0"), f"{base}/in")
    _L(spark, sf).where("txn_id % 50 = 0").select(F.to_json(F.struct(F.col("txn_id").alias("transaction_id"), "type"))) \
        .write.mode("append").text(f"{base}/in")
    run()
    return base


STREAM_ID = ("concat_ws('-', substring(h, 1, 8), substring(h, 9, 4), substring(h, 13, 4), "
             "substring(h, 17, 4), substring(h, 21, 12))")


def _add_streaming(r: dict) -> None:
    from txnscope.streaming import consumer as W

    def alerts(s, d):
        base = _stream_run(s, d)
        return W.read_alerts(s, f"{base}/alerts").drop("saved_at") \
            .withColumn("flags", F.array_join("flags", "|"))
    r["w3_stream_alerts"] = (alerts, _with(ALERTS_CTE, body=(
        f"SELECT {STREAM_ID} AS transaction_id, type, amount, confidence, risk_level, "
        "array_to_string(flags, '|') AS flags, timestamp, nameOrig, nameDest "
        "FROM (SELECT *, sha256(transaction_id) AS h FROM alerts) a")))

    def final(s, d):
        base = _stream_run(s, d)
        return W.final_totals(s, f"{base}/stats").drop("recorded_at")
    r["w7_stream_final_totals"] = (final, _with(STATS_CTE, body=(
        "SELECT processed, fraud_count, fraud_rate, avg_confidence FROM stats "
        "ORDER BY recorded_at DESC LIMIT 1")))

    def accounts(s, d):
        cols = ["messages", "processed", "rejects", "duplicates"]
        return W.read_accounts(s, f"{_stream_run(s, d)}/stats") \
            .agg(F.max_by(F.struct(*cols), "epoch").alias("a")).select("a.*")
    r["w6_stream_accounts"] = (accounts, with_ledger(
        "SELECT count(*) + count(*) FILTER (WHERE txn_id % 3 = 0) + count(*) FILTER (WHERE txn_id % 50 = 0) AS messages, "
        "count(*) AS processed, count(*) FILTER (WHERE txn_id % 50 = 0) AS rejects, "
        "count(*) FILTER (WHERE txn_id % 3 = 0) AS duplicates FROM ledger"))

    def causes(s, d):
        return s.read.parquet(f"{_stream_run(s, d)}/rejects").groupBy("cause").agg(F.count("*").alias("n"))
    r["w1_reject_causes"] = (causes, with_ledger(
        "SELECT 'missing amount,oldbalanceOrg,newbalanceOrig,oldbalanceDest,newbalanceDest' AS cause, count(*) AS n "
        "FROM ledger WHERE txn_id % 50 = 0"))

    def agreement(s, d):
        """The stream with a fitted linear model against batch scoring of the same transactions."""
        from txnscope.learning import models as M
        from txnscope.sources.readers import stable_uuid
        train, _ = _resampled(s, d)
        model = M.pipeline(M.classifier("Logistic Regression", M.ModelSpec(), train.count())).fit(M.with_weights(train))
        base = _stream_run(s, d, W.model_scorer(model))
        found = s.read.parquet(f"{base}/alerts").select("transaction_id", F.col("confidence").alias("streamed"))
        batch = M.batch_score(model, _L(s, d)).where("prediction = 1") \
            .select(stable_uuid("txn_id").alias("transaction_id"), "confidence")
        both = found.join(batch, "transaction_id", "full").agg(
            F.count_if(F.col("streamed").isNull()).alias("missing"), F.count_if(F.col("confidence").isNull()).alias("extra"),
            F.count_if(F.abs(F.col("streamed") - F.col("confidence")) > 1e-9).alias("other_confidence"))
        return W.final_totals(s, f"{base}/stats").select("processed").join(both)
    r["w2_stream_model_agreement"] = (agreement, with_ledger(
        "SELECT count(*) AS processed, 0 AS missing, 0 AS extra, 0 AS other_confidence FROM ledger"))


_REGISTRY: dict[str, tuple[Query, str | None]] | None = None


def registry() -> dict[str, tuple[Query, str | None]]:
    global _REGISTRY
    if _REGISTRY is None:
        _REGISTRY = _registry()
    return _REGISTRY


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in registry().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in registry().items() if v[1] is not None}


__all__ = ["queries", "oracle_sql", "registry", "MODEL_FEATURES"]
