"""Queries over the alert and stats tables written by the scoring stream.

``alerts`` rows: transaction_id, type, amount, confidence, risk_level, flags,
timestamp, nameOrig, nameDest, saved_at.  ``stats`` rows: processed,
fraud_count, fraud_rate, avg_confidence, recorded_at.

``as_of`` is a parameter (a timestamp Column or literal); by default it is the
latest time in the table, stated as a scalar subquery, so results do not depend
on the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from txnscope.functions import exact
from txnscope.functions import rules
from txnscope.schema import ETA_BACKLOG, ETA_NO_RATE

c = F.col


# --- deterministic alert / stats tables derived from transactions -----------
def rule_alerts(txns: DataFrame, threshold: float = 0.5, id_col: str = "txn_id") -> DataFrame:
    """Alert rows as the stream writes them, scored by the deterministic rule
    confidence instead of a model (used to check alert queries end to end)."""
    conf = rules.rule_confidence()
    scored = txns.select(
        c(id_col).cast("string").alias("transaction_id"), "type", "amount",
        conf.alias("p"), rules.flags().alias("flags"),
        c("ts").alias("timestamp"), "nameOrig", "nameDest")
    return scored.filter(c("p") >= threshold).select(
        "transaction_id", "type", "amount",
        F.round(c("p"), 4).alias("confidence"), rules.risk_level("p").alias("risk_level"),
        "flags", "timestamp", "nameOrig", "nameDest", c("timestamp").alias("saved_at"))


def rule_stats(txns: DataFrame, threshold: float = 0.5,
               interval: str = "1 hour") -> DataFrame:
    """Cumulative stats snapshots at the end of each ``interval`` of event time.

    The per-interval aggregate is distributed (partial aggregation); only the
    per-interval rows, bounded by the time span, enter the running-sum window.
    """
    conf = rules.rule_confidence()
    rows = txns.select(F.window("ts", interval).end.alias("recorded_at"),
                       (conf >= threshold).alias("hit"), F.round(conf, 4).alias("conf"))
    per = rows.groupBy("recorded_at").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(c("hit")).alias("f"),
        F.coalesce(exact.units_sum(F.when(c("hit"), c("conf")), 4),
                   F.lit(0).cast("decimal(28,0)")).alias("cs"))
    w = Window.orderBy("recorded_at").rowsBetween(Window.unboundedPreceding, 0)
    run = per.select("recorded_at", F.sum("n").over(w).alias("processed"),
                     F.sum("f").over(w).alias("fraud_count"),
                     F.sum("cs").over(w).alias("conf_sum"))
    # avg confidence (x100, 4 places) half-up from the exact sum of 1e-4 units.
    q = c("conf_sum").cast("decimal(38,0)")
    num = q * F.lit(2 * 100 * 10000) + c("fraud_count").cast("decimal(38,0)") * 10000
    den = c("fraud_count").cast("decimal(38,0)") * 2 * 10000
    avg_conf = F.when(c("fraud_count") == 0, F.lit(0.0)).otherwise(
        ((num - num % den) / den).cast("long").cast("double") / F.lit(10000.0))
    return run.select(c("processed").cast("long").alias("processed"),
                      c("fraud_count").cast("long").alias("fraud_count"),
                      exact.pct(c("fraud_count"), c("processed"), 4).alias("fraud_rate"),
                      avg_conf.alias("avg_confidence"), "recorded_at")


def _latest(df: DataFrame, ts: str) -> Column:
    return df.agg(F.max(ts)).scalar()


# A9 ---------------------------------------------------------------------------
def alert_amount_stats(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        exact.money_sum("amount").alias("total_amount"),
        exact.exact_mean("confidence", 4, 6).alias("avg_conf"),
        F.max("confidence").alias("max_conf"),
        F.min("confidence").alias("min_conf"),
    )


# A10 / A11 ----------------------------------------------------------------------
def alerts_by(alerts: DataFrame, key: str) -> DataFrame:
    return alerts.groupBy(key).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), key)


# A12 --------------------------------------------------------------------------
def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table, one row each (one aggregate job per table,
    unioned into a single plan)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dataset_fraud_rate(txns: DataFrame) -> DataFrame:
    return txns.agg(F.count(F.lit(1)).alias("total"),
                    F.count_if(c("isFraud") == 1).alias("fraud")) \
        .select("total", "fraud", exact.pct(c("fraud"), c("total"), 4).alias("fraud_rate"))


# A13 / A14 ----------------------------------------------------------------------
def first_and_latest(stats: DataFrame) -> DataFrame:
    row = F.struct(*[c(x) for x in stats.columns])
    return stats.agg(F.min_by(row, c("recorded_at")).alias("first"),
                     F.max_by(row, c("recorded_at")).alias("latest")) \
        .select(*[c(f"first.{x}").alias(f"first_{x}") for x in ("processed", "recorded_at")],
                *[c(f"latest.{x}").alias(f"latest_{x}") for x in stats.columns])


def throughput(stats: DataFrame, backlog: int = ETA_BACKLOG) -> DataFrame:
    """Messages per second between the first and latest snapshot and the
    hours left for ``backlog`` messages (999 when the rate is 0)."""
    fl = first_and_latest(stats)
    elapsed = (F.unix_micros(c("latest_recorded_at")) - F.unix_micros(c("first_recorded_at"))) \
        / F.lit(1e6)
    return fl.select(c("latest_processed").alias("processed"), elapsed.alias("elapsed_sec")) \
        .withColumn("rate", F.when(c("elapsed_sec") != 0, c("processed") / c("elapsed_sec"))
                    .otherwise(F.lit(0.0))) \
        .withColumn("eta_hours", F.when(c("rate") != 0, F.lit(float(backlog)) / c("rate") / 3600)
                    .otherwise(F.lit(float(ETA_NO_RATE))))


# A16 / P8 -----------------------------------------------------------------------
def rolling_alert_counts(alerts: DataFrame, as_of: Column | None = None,
                         ts: str = "saved_at") -> DataFrame:
    now = _latest(alerts, ts) if as_of is None else as_of
    t = c(ts)
    return alerts.agg(
        F.count_if(t >= now - F.expr("INTERVAL 5 MINUTES")).alias("last_5m"),
        F.count_if(t >= now - F.expr("INTERVAL 1 HOUR")).alias("last_1h"),
        F.count(F.lit(1)).alias("total"))


def since(df: DataFrame, ts: str, interval: str, as_of: Column | None = None) -> DataFrame:
    """P8: rows with ``ts >= as_of - interval``; pushed into the scan as a
    range filter when ``as_of`` is a literal."""
    now = _latest(df, ts) if as_of is None else as_of
    return df.filter(c(ts) >= now - F.expr(f"INTERVAL {interval}"))


# A17 --------------------------------------------------------------------------
def recent_stats_series(stats: DataFrame, minutes: int = 30,
                        as_of: Column | None = None) -> DataFrame:
    return since(stats, "recorded_at", f"{minutes} MINUTES", as_of) \
        .select("recorded_at", "fraud_count").orderBy("recorded_at")


# T4 ---------------------------------------------------------------------------
def latest_alerts(alerts: DataFrame, n: int = 12) -> DataFrame:
    return alerts.orderBy(F.desc("saved_at"), F.desc("transaction_id")).limit(n)


def alert_cards(alerts: DataFrame, n: int = 12) -> DataFrame:
    """Latest alerts with the display fields: short id, time text, flag text,
    confidence percent."""
    return latest_alerts(alerts, n).select(
        F.substring("transaction_id", 1, 8).alias("short_id"),
        F.date_format("saved_at", "yyyy-MM-dd HH:mm:ss").alias("saved_at_text"),
        "type", "amount", "risk_level",
        rules.flags_text("flags").alias("flags_text"),
        F.round(c("confidence") * 100, 1).alias("confidence_pct"))
