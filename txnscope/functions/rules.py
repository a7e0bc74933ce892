"""Scoring rules: explanatory flags, risk bands, labels and risk-factor scores.

All built-in expressions; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnscope.functions import features as fx
from txnscope.schema import (FACTOR_HIGH, FACTOR_MEDIUM, FLAG_DRAINED, FLAG_LARGE,
                             FLAG_ROUND, FLAG_ZERO, LARGE_AMOUNT, LOW_THRESHOLD,
                             MEDIUM_THRESHOLD, ROUND_FACTOR_SCORE,
                             ZERO_BALANCE_FACTOR_SCORE)

c = F.col

# --- fixed values: risk-factor names, in display order ----------------------
FACTOR_NAMES = ["Balance Drain", "Money Vanished", "Amount Size",
                "Amount/Balance Ratio", "Round Number", "Zero Starting Balance"]
NO_FLAGS_STREAM = "—"          # shown by the stream printer
NO_FLAGS_PAGE = "No specific flags"  # shown on the alert page
LABEL_FRAUD, LABEL_LEGIT = "FRAUD", "LEGITIMATE"
# ---------------------------------------------------------------------------


def flags() -> Column:
    """explanatory flags, fixed order; empty array when none apply."""
    old = c("oldbalanceOrg")
    drained = (old > 0) & (fx.balance_diff_orig() >= old)
    return F.filter(F.array(
        F.when(drained, F.lit(FLAG_DRAINED)),
        F.when(c("amount") > LARGE_AMOUNT, F.lit(FLAG_LARGE)),
        F.when(fx.is_round_amount() == 1, F.lit(FLAG_ROUND)),
        F.when(old == 0, F.lit(FLAG_ZERO)),
    ), lambda x: x.isNotNull())


def risk_level(prob: Column | str) -> Column:
    """band on the unrounded probability."""
    p = c(prob) if isinstance(prob, str) else prob
    return (F.when(p < LOW_THRESHOLD, F.lit("LOW"))
            .when(p < MEDIUM_THRESHOLD, F.lit("MEDIUM"))
            .otherwise(F.lit("HIGH")))


def prediction_label(pred: Column | str) -> Column:
    """F13."""
    p = c(pred) if isinstance(pred, str) else pred
    return F.when(p == 1, F.lit(LABEL_FRAUD)).otherwise(F.lit(LABEL_LEGIT))


def flags_text(flag_col: Column | str = "flags", empty: str = NO_FLAGS_PAGE) -> Column:
    """flags joined with ", ", a placeholder when there are none."""
    f = c(flag_col) if isinstance(flag_col, str) else flag_col
    return F.when(F.coalesce(F.size(f), F.lit(0)) <= 0, F.lit(empty)) \
        .otherwise(F.concat_ws(", ", f))


def fraud_label(is_fraud: Column | str = "isFraud", legit: str = "Legitimate") -> Column:
    """P9: 1 -> Fraud, else ``legit`` (the two reports use Legit / Legitimate)."""
    x = c(is_fraud) if isinstance(is_fraud, str) else is_fraud
    return F.when(x == 1, F.lit("Fraud")).otherwise(F.lit(legit))


# F15 / F16 ------------------------------------------------------------------
def factor_scores() -> dict[str, Column]:
    """Six risk-factor scores on a 0-100 scale (drain has no lower bound)."""
    old = c("oldbalanceOrg")
    drain_pct = F.when(old > 0, fx.balance_diff_orig() / old * 100).otherwise(F.lit(0.0))
    vanished = F.when((fx.balance_diff_dest() <= 0) & (c("amount") > 0), F.lit(100.0)) \
        .otherwise(F.lit(0.0))
    size = F.least(c("amount") / LARGE_AMOUNT * 100, F.lit(100.0))
    ratio = F.least(fx.amount_to_balance_ratio() * 100, F.lit(100.0))
    rnd = F.when(fx.is_round_amount() == 1, F.lit(float(ROUND_FACTOR_SCORE))).otherwise(F.lit(0.0))
    zero = F.when(fx.zero_orig_balance() == 1, F.lit(float(ZERO_BALANCE_FACTOR_SCORE))) \
        .otherwise(F.lit(0.0))
    return dict(zip(FACTOR_NAMES, [F.least(drain_pct, F.lit(100.0)), vanished, size,
                                   ratio, rnd, zero]))


def factor_band(score: Column | str) -> Column:
    """F16: colour band of one factor score."""
    s = c(score) if isinstance(score, str) else score
    return (F.when(s >= FACTOR_HIGH, F.lit("high"))
            .when(s >= FACTOR_MEDIUM, F.lit("medium"))
            .otherwise(F.lit("low")))


def factor_array() -> Column:
    """Risk factors as array<struct<factor, score>> in display order."""
    return F.array(*[F.struct(F.lit(n).alias("factor"), s.alias("score"))
                     for n, s in factor_scores().items()])


def rule_confidence() -> Column:
    """Deterministic stand-in probability: mean factor score / 100, clamped to
    [0, 1] and truncated to 4 decimals.

    Used where alert tables must be rebuilt identically without a trained
    model (checks of the alert operators).  Truncation (floor) keeps the value
    on the 4-decimal grid without a rounding tie rule."""
    scores = list(factor_scores().values())
    total = scores[0]
    for s in scores[1:]:
        total = total + s
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), total / len(scores) / 100))
    return F.floor(p * 10000).cast("double") / 10000
