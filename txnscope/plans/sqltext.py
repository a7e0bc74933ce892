"""SQL twins of the column rules, for the independent checker (DuckDB dialect).

Each fragment is written over the ``ledger`` columns in the same operation
order as the Spark expression, so IEEE results agree bit for bit.
"""

from __future__ import annotations

from txnscope.schema import (FLAG_DRAINED, FLAG_LARGE, FLAG_ROUND, FLAG_ZERO, LARGE_AMOUNT,
                             LOW_THRESHOLD, MEDIUM_THRESHOLD, ROUND_FACTOR_SCORE, ROUND_UNIT,
                             TYPE_CODES, ZERO_BALANCE_FACTOR_SCORE)

TYPE_ENCODED = "CASE type " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in TYPE_CODES.items()) + " ELSE -1 END"

DIFF_ORIG = "(oldbalanceOrg - newbalanceOrig)"
DIFF_DEST = "(newbalanceDest - oldbalanceDest)"
RATIO = "(amount / (oldbalanceOrg + 1.0))"
IS_ROUND = f"CAST(amount % {ROUND_UNIT} = 0 AS INTEGER)"
ZERO_ORIG = "CAST(oldbalanceOrg = 0 AS INTEGER)"

F_DRAIN = (f"least(CASE WHEN oldbalanceOrg > 0 THEN {DIFF_ORIG} / oldbalanceOrg * 100 "
           f"ELSE 0.0 END, 100.0)")
F_VANISH = f"(CASE WHEN {DIFF_DEST} <= 0 AND amount > 0 THEN 100.0 ELSE 0.0 END)"
F_SIZE = f"least(amount / {LARGE_AMOUNT} * 100, 100.0)"
F_RATIO = f"least({RATIO} * 100, 100.0)"
F_ROUND = f"(CASE WHEN {IS_ROUND} = 1 THEN {float(ROUND_FACTOR_SCORE)} ELSE 0.0 END)"
F_ZERO = f"(CASE WHEN {ZERO_ORIG} = 1 THEN {float(ZERO_BALANCE_FACTOR_SCORE)} ELSE 0.0 END)"
FACTORS = [F_DRAIN, F_VANISH, F_SIZE, F_RATIO, F_ROUND, F_ZERO]

RULE_CONFIDENCE = (
    "(CAST(floor(greatest(0.0, least(1.0, "
    f"((((({F_DRAIN} + {F_VANISH}) + {F_SIZE}) + {F_RATIO}) + {F_ROUND}) + {F_ZERO}) / 6 / 100"
    ")) * 10000) AS DOUBLE) / 10000)")

FLAGS = (
    "list_filter([" +
    f"CASE WHEN oldbalanceOrg > 0 AND {DIFF_ORIG} >= oldbalanceOrg THEN '{FLAG_DRAINED}' END, "
    f"CASE WHEN amount > {LARGE_AMOUNT} THEN '{FLAG_LARGE}' END, "
    f"CASE WHEN {IS_ROUND} = 1 THEN '{FLAG_ROUND}' END, "
    f"CASE WHEN oldbalanceOrg = 0 THEN '{FLAG_ZERO}' END"
    "], lambda x: x IS NOT NULL)")


def flags_text(lst: str, empty: str = "No specific flags") -> str:
    return f"(CASE WHEN len({lst}) = 0 THEN '{empty}' ELSE array_to_string({lst}, ', ') END)"


def risk_level(p: str) -> str:
    return (f"(CASE WHEN {p} < {LOW_THRESHOLD} THEN 'LOW' "
            f"WHEN {p} < {MEDIUM_THRESHOLD} THEN 'MEDIUM' ELSE 'HIGH' END)")


def fraud_label(x: str = "isFraud", legit: str = "Legitimate") -> str:
    return f"(CASE WHEN {x} = 1 THEN 'Fraud' ELSE '{legit}' END)"


# Alert rows scored by the rule confidence (threshold 0.5).
RULE_ALERTS = f"""
SELECT CAST(txn_id AS VARCHAR) AS transaction_id, type, amount,
       round(p, 4) AS confidence, {risk_level('p')} AS risk_level, flags,
       ts AS timestamp, nameOrig, nameDest, ts AS saved_at
FROM (SELECT *, {RULE_CONFIDENCE} AS p, {FLAGS} AS flags FROM ledger) s
WHERE p >= 0.5
"""


def rule_stats(interval_minutes: int) -> str:
    iv = f"INTERVAL {interval_minutes} MINUTES"
    return f"""
SELECT CAST(processed AS BIGINT) AS processed, CAST(fraud_count AS BIGINT) AS fraud_count,
  (CASE WHEN processed = 0 THEN 0.0 ELSE CAST((CAST(fraud_count AS HUGEINT) * 2000000 + processed)
     // (2 * CAST(processed AS HUGEINT)) AS DOUBLE) / 10000.0 END) AS fraud_rate,
  (CASE WHEN fraud_count = 0 THEN 0.0 ELSE
     CAST((CAST(conf_sum AS HUGEINT) * 2000000 + CAST(fraud_count AS HUGEINT) * 10000)
          // (CAST(fraud_count AS HUGEINT) * 2 * 10000) AS DOUBLE) / 10000.0 END) AS avg_confidence,
  recorded_at
FROM (
  SELECT recorded_at,
    sum(n) OVER (ORDER BY recorded_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS processed,
    sum(f) OVER (ORDER BY recorded_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fraud_count,
    sum(cs) OVER (ORDER BY recorded_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS conf_sum
  FROM (
    SELECT time_bucket({iv}, ts) + {iv} AS recorded_at, count(*) AS n,
      count(*) FILTER (WHERE p >= 0.5) AS f,
      coalesce(sum(CAST(round(round(p, 4) * 10000.0) AS BIGINT)) FILTER (WHERE p >= 0.5), 0) AS cs
    FROM (SELECT ts, {RULE_CONFIDENCE} AS p FROM ledger) s
    GROUP BY 1
  ) per
) run
"""
