"""Declared schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the analysed application's constants) --------
# Transaction types and their integer codes, in code order.
TYPE_CODES = {"CASH_IN": 0, "CASH_OUT": 1, "DEBIT": 2, "PAYMENT": 3, "TRANSFER": 4}
UNKNOWN_TYPE_CODE = -1
UNKNOWN_TYPE_NAME = "UNKNOWN"

# Feature list used by the scoring model, in model order.
MODEL_FEATURES = [
    "type_encoded", "amount", "oldbalanceOrg", "newbalanceOrig",
    "oldbalanceDest", "newbalanceDest",
    "balance_diff_orig", "balance_diff_dest",
    "amount_to_balance_ratio", "is_round_amount", "zero_orig_balance",
]
# Feature list of the exploratory helper set, in its order.
HELPER_FEATURES = [
    "type_encoded", "amount", "amount_log", "oldbalanceOrg", "newbalanceOrig",
    "oldbalanceDest", "newbalanceDest", "balance_diff_orig", "balance_diff_dest",
    "error_balance_orig", "error_balance_dest",
]
TARGET = "isFraud"

# Risk bands on the unrounded fraud probability.
LOW_THRESHOLD = 0.30
MEDIUM_THRESHOLD = 0.60

# Explanatory flags, in output order.
FLAG_DRAINED = "Entire balance drained"
FLAG_LARGE = "Unusually large amount"
FLAG_ROUND = "Round number amount"
FLAG_ZERO = "Zero starting balance"
LARGE_AMOUNT = 400_000
ROUND_UNIT = 1000

# Amount buckets: upper edges (exclusive) and labels, in ascending order.
AMOUNT_BUCKETS = [
    (1_000, "0-1K"),
    (10_000, "1K-10K"),
    (100_000, "10K-100K"),
    (500_000, "100K-500K"),
    (None, "500K+"),
]

# Risk-factor scores shown for one transaction (0-100 scale).
ROUND_FACTOR_SCORE = 40
ZERO_BALANCE_FACTOR_SCORE = 60
FACTOR_HIGH = 60
FACTOR_MEDIUM = 30

# Model comparison defaults (full size).
RANDOM_STATE = 42
TEST_FRACTION = 0.20
SMOTE_RATIO = 0.1
SMOTE_K = 5
STATS_INTERVAL_SECONDS = 60
DEFAULT_STREAM_LIMIT = 100_000
ETA_BACKLOG = 2_234_638
ETA_NO_RATE = 999
# ---------------------------------------------------------------------------

# Raw transaction record (CSV and table form).
TXN_COLUMNS = [
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
]
TXN_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])

RAW_SCORING_FIELDS = ["type", "amount", "oldbalanceOrg", "newbalanceOrig",
                      "oldbalanceDest", "newbalanceDest"]

# JSON message on the transaction stream.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("nameDest", T.StringType()),
])

ALERT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("flags", T.ArrayType(T.StringType())),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("saved_at", T.TimestampType()),
])

STATS_SCHEMA = T.StructType([
    T.StructField("processed", T.LongType()),
    T.StructField("fraud_count", T.LongType()),
    T.StructField("fraud_rate", T.DoubleType()),
    T.StructField("avg_confidence", T.DoubleType()),
    T.StructField("recorded_at", T.TimestampType()),
])
