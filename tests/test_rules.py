"""Feature and scoring rules on frames (fixtures from the analysed application's unit tests)."""
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txnscope.functions import features as fx
from txnscope.functions import rules
from txnscope.schema import HELPER_FEATURES, MODEL_FEATURES, TARGET

COLS = "type string, amount double, oldbalanceOrg double, newbalanceOrig double, " \
       "oldbalanceDest double, newbalanceDest double, isFraud int"

HELPER_ROWS = [
    ("TRANSFER", 10000.0, 10000.0, 0.0, 0.0, 10000.0, 1),
    ("PAYMENT", 250.0, 50000.0, 49750.0, 0.0, 0.0, 0),
    ("CASH_OUT", 50000.0, 60000.0, 10000.0, 100000.0, 150000.0, 0),
    ("CASH_IN", 3000.0, 0.0, 3000.0, 50000.0, 47000.0, 0),
    ("DEBIT", 1500.0, 8000.0, 6500.0, 0.0, 0.0, 0),
]


def test_type_encoding_and_helper_features(spark):
    df = spark.createDataFrame(HELPER_ROWS, COLS)
    out = fx.helper_features(df).collect()
    assert [r.type_encoded for r in out] == [4, 3, 1, 0, 2]
    assert [r.balance_diff_orig for r in out] == [10000, 250, 50000, -3000, 1500]
    for r in out:
        assert r.amount_log == pytest.approx(math.log1p(r.amount))
    assert df.columns == COLS_NAMES  # input frame untouched
    assert set(HELPER_FEATURES) <= set(fx.helper_features(df).columns)


COLS_NAMES = ["type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
              "newbalanceDest", "isFraud"]


def test_unknown_type_is_minus_one_and_decodes(spark):
    df = spark.createDataFrame([("BOGUS",), (None,), ("DEBIT",)], "type string")
    enc = [r[0] for r in df.select(fx.type_encoded()).collect()]
    assert enc == [-1, -1, 2]
    dec = [r[0] for r in spark.createDataFrame([(4,), (-1,), (9,)], "type_encoded int")
           .select(fx.type_decoded()).collect()]
    assert dec == ["TRANSFER", "UNKNOWN", "UNKNOWN"]


FRAUD = ("TRANSFER", 750000.0, 750000.0, 0.0, 0.0, 750000.0, 1)
LEGIT = ("PAYMENT", 1250.50, 45000.0, 43749.50, 0.0, 0.0, 0)
ROUND = ("CASH_OUT", 5000.0, 10000.0, 5000.0, 0.0, 5000.0, 0)
ZERO = ("CASH_IN", 1000.0, 0.0, 1000.0, 50000.0, 49000.0, 0)
ROUND_LARGE = ("TRANSFER", 500000.0, 500000.0, 0.0, 0.0, 500000.0, 1)


def test_model_features(spark):
    df = spark.createDataFrame([FRAUD, LEGIT, ROUND, ZERO], COLS)
    out = fx.model_features(df).collect()
    assert set(MODEL_FEATURES) <= set(out[0].asDict())
    assert out[0].type_encoded == 4
    assert out[1].balance_diff_orig == pytest.approx(1250.50)
    assert out[1].is_round_amount == 0
    assert out[2].is_round_amount == 1
    assert out[3].zero_orig_balance == 1
    assert out[0].amount_to_balance_ratio == pytest.approx(750000 / 750001)


def test_features_and_target_types(spark):
    df = spark.createDataFrame([FRAUD, LEGIT], COLS)
    xy = fx.features_and_target(df)
    assert xy.columns == HELPER_FEATURES + [TARGET]
    assert dict(xy.dtypes)["type_encoded"] == "double"
    assert dict(xy.dtypes)[TARGET] == "int"


def test_ratio_null_not_error_on_minus_one(spark):
    df = spark.createDataFrame([(5.0, -1.0)], "amount double, oldbalanceOrg double")
    assert df.select(fx.amount_to_balance_ratio()).first()[0] is None


@pytest.mark.parametrize("p,band", [(0.0, "LOW"), (0.10, "LOW"), (0.29, "LOW"), (0.30, "MEDIUM"),
                                    (0.59, "MEDIUM"), (0.60, "HIGH"), (0.99, "HIGH"),
                                    (1.0, "HIGH")])
def test_risk_bands(spark, p, band):
    assert spark.range(1).select(rules.risk_level(F.lit(p))).first()[0] == band


def _flags(spark, row):
    return spark.createDataFrame([row], COLS).select(rules.flags()).first()[0]


def test_flags(spark):
    assert _flags(spark, FRAUD) == ["Entire balance drained", "Unusually large amount",
                                    "Round number amount"]
    assert _flags(spark, LEGIT) == []
    assert "Round number amount" in _flags(spark, ROUND_LARGE)
    assert _flags(spark, ZERO) == ["Round number amount", "Zero starting balance"]


def test_flags_text_and_labels(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "flags array<string>")
    assert [r[0] for r in df.select(rules.flags_text()).collect()] == ["a, b",
                                                                       "No specific flags"]
    assert spark.range(1).select(rules.prediction_label(F.lit(1)),
                                 rules.prediction_label(F.lit(0))).first()[:] == \
        ("FRAUD", "LEGITIMATE")


def test_risk_factor_scores(spark):
    vanish = ("CASH_OUT", 450000.0, 450000.0, 0.0, 0.0, 0.0, 1)
    df = spark.createDataFrame([vanish, LEGIT], COLS)
    rows = df.select(*[v.alias(k) for k, v in rules.factor_scores().items()]).collect()
    v = rows[0].asDict()
    assert v["Balance Drain"] == 100.0 and v["Money Vanished"] == 100.0
    assert v["Amount Size"] == 100.0 and v["Round Number"] == 40.0
    assert v["Zero Starting Balance"] == 0.0
    legit = rows[1].asDict()
    assert legit["Amount Size"] == pytest.approx(1250.5 / 400000 * 100)
    bands = [r[0] for r in spark.createDataFrame([(60.0,), (59.9,), (30.0,), (29.9,)], "s double")
             .select(rules.factor_band("s")).collect()]
    assert bands == ["high", "medium", "medium", "low"]


def test_timestamp_format(spark):
    df = spark.createDataFrame([(datetime(2026, 4, 8, 15, 30, 45),)], "ts timestamp")
    stamp = df.select(fx.file_stamp(F.col("ts"))).first()[0]
    assert stamp == "20260408_153045" and len(stamp) == 15


def test_constants():
    assert len(MODEL_FEATURES) == 11 and len(HELPER_FEATURES) == 11
    assert TARGET == "isFraud"


def test_ledger_step_same_in_any_session_zone(spark):
    from tests.conftest import SF_SMALL
    from txnscope.sources.ledger import ledger
    utc = sorted(tuple(r) for r in ledger(spark, SF_SMALL).select("txn_id", "step").collect())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = sorted(tuple(r) for r in ledger(spark, SF_SMALL).select("txn_id", "step").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
