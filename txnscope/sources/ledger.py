"""The ``ledger``: a transaction table derived row by row from ``events``.

The test tables carry no transaction table, so every operator reads this
projection of ``events``.  It is a narrow, per-row map (no shuffle, no
randomness): Catalyst folds it into the Parquet scan stage, and the same rules
are written once more in SQL (``LEDGER_SQL``) so an independent engine can
rebuild the identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event kind -> transaction type.
EVENT_TYPE_MAP = {
    "signup": "CASH_IN",
    "error": "CASH_OUT",
    "view": "DEBIT",
    "click": "PAYMENT",
    "purchase": "TRANSFER",
}
EPOCH_NTZ = "2024-01-01 00:00:00"
EPOCH_SECONDS = 1704067200
US_PER_HOUR = 3_600_000_000


def _step(ts: Column, utc_session: bool) -> Column:
    """Whole hours since the epoch, plus one, of a wall-clock (NTZ) time.

    In a UTC session the wall clock read as a UTC instant gives the micros
    directly; any other session time zone takes the zone-independent
    ``timestampdiff`` (slower: it converts through local date-times)."""
    if utc_session:
        us = F.unix_micros(ts.cast("timestamp_ntz").cast("timestamp")) \
            - F.lit(EPOCH_SECONDS * 1_000_000)
    else:
        us = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"),
                              ts.cast("timestamp_ntz"))
    return (F.floor(us / F.lit(US_PER_HOUR)) + 1).cast("int")


def ledger_from_events(events: DataFrame) -> DataFrame:
    """Three narrow projections (base values, opening balances, the rest) so
    each expression is evaluated once and referenced by name, instead of one
    projection whose later columns repeat the earlier expressions inline."""
    utc = events.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z")
    eid = F.col("event_id")
    kind = F.col("event_type")
    tx_type = F.coalesce(
        *[F.when(kind == k, F.lit(v)) for k, v in EVENT_TYPE_MAP.items()],
        F.lit("UNKNOWN"))
    base = events.select(
        eid, "ts", "user_id", tx_type.alias("type"),
        # round(value * 2000, 2), written with rint: the same doubles (value *
        # 2000 has at most two decimals) without a BigDecimal per row.
        (F.rint(F.col("value") * 200000) / 100).alias("amount"))
    amount = F.col("amount")
    opening = base.select(
        "*",
        F.when(eid % 5 == 0, F.lit(0.0)).when(eid % 5 == 1, amount)
        .otherwise(amount + ((eid * 37) % 1000 * 100).cast("double")).alias("oldbalanceOrg"),
        ((eid * 53) % 1000 * 100).cast("double").alias("oldbalanceDest"))
    old_orig, old_dest, tx = F.col("oldbalanceOrg"), F.col("oldbalanceDest"), F.col("type")
    return opening.select(
        eid.alias("txn_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        _step(F.col("ts"), utc).alias("step"),
        "type", "amount",
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        "oldbalanceOrg",
        F.when(tx == "CASH_IN", old_orig + amount)
        .otherwise(F.greatest(old_orig - amount, F.lit(0.0))).alias("newbalanceOrig"),
        F.concat(F.lit("M"), ((eid * 7919) % 97).cast("string")).alias("nameDest"),
        "oldbalanceDest",
        F.when(eid % 7 == 0, old_dest).otherwise(old_dest + amount).alias("newbalanceDest"),
        (tx.isin("CASH_OUT", "TRANSFER")
         & (((eid % 5 == 1) & (eid % 3 == 0)) | (eid % 41 == 0))).cast("int").alias("isFraud"),
        ((tx == "TRANSFER") & (amount > 200000)).cast("int").alias("isFlaggedFraud"),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions for the test tables at ``sf_dir``."""
    return ledger_from_events(read_table(spark, sf_dir, "events"))


# The same rules in ANSI SQL for the independent checker (DuckDB dialect for
# the epoch function).  Used as ``WITH ledger AS (...)``.
LEDGER_SQL = f"""
SELECT
  event_id AS txn_id,
  ts,
  CAST(floor((epoch(ts) - {EPOCH_SECONDS}) / 3600) + 1 AS INTEGER) AS step,
  type,
  amount,
  'C' || CAST(user_id AS VARCHAR) AS nameOrig,
  oldbalanceOrg,
  CASE WHEN type = 'CASH_IN' THEN oldbalanceOrg + amount
       ELSE greatest(oldbalanceOrg - amount, 0.0) END AS newbalanceOrig,
  'M' || CAST((event_id * 7919) % 97 AS VARCHAR) AS nameDest,
  oldbalanceDest,
  CASE WHEN event_id % 7 = 0 THEN oldbalanceDest
       ELSE oldbalanceDest + amount END AS newbalanceDest,
  CAST(type IN ('CASH_OUT', 'TRANSFER')
       AND ((event_id % 5 = 1 AND event_id % 3 = 0) OR event_id % 41 = 0) AS INTEGER) AS isFraud,
  CAST(type = 'TRANSFER' AND amount > 200000 AS INTEGER) AS isFlaggedFraud
FROM (
  SELECT event_id, ts, user_id, type, amount,
    CASE WHEN event_id % 5 = 0 THEN 0.0
         WHEN event_id % 5 = 1 THEN amount
         ELSE amount + CAST(((event_id * 37) % 1000) * 100 AS DOUBLE) END AS oldbalanceOrg,
    CAST(((event_id * 53) % 1000) * 100 AS DOUBLE) AS oldbalanceDest
  FROM (
    SELECT event_id, ts, user_id,
      CASE event_type WHEN 'signup' THEN 'CASH_IN' WHEN 'error' THEN 'CASH_OUT'
        WHEN 'view' THEN 'DEBIT' WHEN 'click' THEN 'PAYMENT'
        WHEN 'purchase' THEN 'TRANSFER' ELSE 'UNKNOWN' END AS type,
      round(value * 2000, 2) AS amount
    FROM events
  ) e0
) e1
"""


def with_ledger(sql: str) -> str:
    """Prefix a query over ``ledger`` with the ledger definition."""
    return f"WITH ledger AS ({LEDGER_SQL})\n{sql}"
