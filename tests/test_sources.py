"""Sources and sinks: typed CSV, reject split, skip-if-populated load, tables."""
import os

from txnscope.schema import TXN_COLUMNS
from txnscope.sources import readers as R

HEADER = ",".join(TXN_COLUMNS)
GOOD = ["1,PAYMENT,9839.64,C1231006815,170136.0,160296.36,M1979787155,0.0,0.0,0,0",
        "1,TRANSFER,181.0,C1305486145,181.0,0.0,C553264065,0.0,0.0,1,0"]
BAD = ["x,PAYMENT,abc,C1,1,1,M1,0,0,0,0"]


def _csv(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")
    return path


def test_typed_csv_and_inferred(spark, tmp_dir):
    p = _csv(f"{tmp_dir}/t.csv", GOOD)
    df = R.read_transactions_csv(spark, p)
    assert df.columns == TXN_COLUMNS and dict(df.dtypes)["step"] == "int"
    assert df.count() == 2
    raw = R.load_raw(spark, p)
    assert dict(raw.dtypes)["amount"] == "double"
    assert R.load_processed(spark, p).count() == 2


def test_reject_split_and_skip_if_populated(spark, tmp_dir):
    p = _csv(f"{tmp_dir}/t.csv", GOOD + BAD)
    txn, fraud = f"{tmp_dir}/transactions", f"{tmp_dir}/fraud_cases"
    out = R.load_transactions(spark, p, txn, fraud, f"{tmp_dir}/staging1",
                              quarantine=f"{tmp_dir}/quarantine")
    assert out == {"skipped": False, "transactions": 2, "fraud_cases": 1, "rejected": 1}
    assert R.has_rows(spark, txn) and R.has_rows(spark, fraud)
    again = R.load_transactions(spark, p, txn, fraud, f"{tmp_dir}/staging2")
    assert again["skipped"] is True
    assert spark.read.parquet(txn).count() == 2
    assert spark.read.parquet(f"{tmp_dir}/quarantine").count() == 1


def test_has_rows_missing_and_table_roundtrip(spark, tmp_dir):
    assert not R.has_rows(spark, f"{tmp_dir}/nope")
    df = spark.createDataFrame([(1, "a", 5)], "a int, b string, _id int")
    R.write_table(df, f"{tmp_dir}/tbl")
    back = spark.read.parquet(f"{tmp_dir}/tbl")
    assert back.count() == 1
    assert os.path.isdir(f"{tmp_dir}/tbl")


def test_csv_columns_bound_by_header_name(spark, tmp_dir):
    """Reordered and extra columns, and NaN, which is loaded as null."""
    path = f"{tmp_dir}/t.csv"
    names = ["extra", *reversed(TXN_COLUMNS)]
    values = {"step": "1", "type": "PAYMENT", "amount": "NaN", "nameOrig": "C1", "oldbalanceOrg": "181.0",
              "newbalanceOrig": "0.0", "nameDest": "M1", "oldbalanceDest": "1.0", "newbalanceDest": "2.0",
              "isFraud": "0", "isFlaggedFraud": "0", "extra": "x"}
    with open(path, "w") as f:
        f.write(",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n")
    row = R.read_transactions_csv(spark, path).first()
    assert (row["oldbalanceOrg"], row["newbalanceOrig"], row["step"]) == (181.0, 0.0, 1)
    accepted, rejected, counts = R.split_valid(spark, path, f"{tmp_dir}/staging")
    assert accepted.first()["amount"] is None and counts["accepted"] == 1 and rejected.count() == 0


def test_money_keeps_digits_below_a_cent(spark):
    from pyspark.sql import functions as F

    from txnscope.functions import exact
    got = spark.range(1000).select(F.lit(0.004).alias("amount")).agg(exact.money_sum("amount").alias("s")).first()["s"]
    assert got == 4.0


def test_rejects_tell_every_wrong_field(spark, tmp_dir):
    bad = ["x,PAYMENT,abc,C1,1,1,M1,0,0,0,0", "1,PAYMENT,1.0,C1,1,1,M1", GOOD[0] + ",more", "1.5,PAYMENT,2,C1,1,1,M1,0,0,0,0",
           '1,PAYMENT,"1,000.5",C1,1,1,M1,0,0,maybe,0']
    p = _csv(f"{tmp_dir}/t.csv", GOOD + bad + ["2,DEBIT,,C1,1,1,M1,0,0,0,0"])
    out = R.load_transactions(spark, p, f"{tmp_dir}/t", f"{tmp_dir}/f", f"{tmp_dir}/s", f"{tmp_dir}/q", f"{tmp_dir}/sum")
    assert (out["transactions"], out["rejected"]) == (3, 5)          # an empty field is null, not wrong
    got = {r[R.CORRUPT]: r.reasons for r in spark.read.parquet(f"{tmp_dir}/q").collect()}
    assert got["x,PAYMENT,abc,C1,1,1,M1,0,0,0,0"] == ["step is no int: x", "amount is no double: abc"]
    assert got["1,PAYMENT,1.0,C1,1,1,M1"] == got[GOOD[0] + ",more"] == ["another number of fields"]
    assert ["step is no int: 1.5"] in got.values()
    assert ["amount is no double: 1,000.5", "isFraud is no int: maybe"] in got.values()
    assert {r.type: r.total_count for r in spark.read.parquet(f"{tmp_dir}/sum").collect()} == {"PAYMENT": 1, "TRANSFER": 1, "DEBIT": 1}


def test_exported_documents_plain_and_wrapped(spark, tmp_dir):
    from pyspark.sql import types as T
    with open(f"{tmp_dir}/d.json", "w") as f:
        f.write("""{"_id": {"$oid": "64"}, "type": "TRANSFER", "amount": {"$numberDouble": "1.5"}, "step": {"$numberInt": "3"}, "at": {"$date": "2024-01-01T00:00:00Z"}}
{"_id": 1, "type": "TRANSFER", "amount": 2, "step": 4.0, "at": {"$date": {"$numberLong": "1704067200000"}}, "more": [1]}
{"type": "PAYMENT", "amount": {"$numberDecimal": "7.25"}, "step": {"$numberLong": "5"}}
{"type": "TRANSFER", "amount": {"$numberDouble": "NaN"}, "step": "x"}
""")
    schema = T.StructType([T.StructField("type", T.StringType()), T.StructField("amount", T.DoubleType()),
                           T.StructField("step", T.IntegerType()), T.StructField("at", T.TimestampType())])
    rows = R.read_documents(spark, f"{tmp_dir}/d.json", schema).collect()
    assert [(r.type, r.step) for r in rows] == [("TRANSFER", 3), ("TRANSFER", 4), ("PAYMENT", 5), ("TRANSFER", None)]
    assert [r.amount for r in rows[:3]] == [1.5, 2.0, 7.25] and rows[3].amount != rows[3].amount
    assert rows[0]["at"] == rows[1]["at"] and rows[0]["at"] is not None and rows[2]["at"] is None
    some = R.read_documents(spark, f"{tmp_dir}/d.json", T.StructType(schema.fields[:2]), where={"type": "PAYMENT"})
    assert [r.amount for r in some.collect()] == [7.25]
    plan = some._jdf.queryExecution().toString()
    assert "EqualTo(type,PAYMENT)" in plan.split("PushedFilters")[1] and "step" not in plan.split("ReadSchema")[1][:80]


def test_stored_sketches_merge_for_any_range(spark):
    import numpy as np

    from txnscope.operators import metrics as me
    r = np.random.default_rng(2)
    values = np.r_[r.lognormal(8, 2, 30000), [np.nan]]
    df = spark.createDataFrame([(int(i % 7), float(v)) for i, v in enumerate(values)], "day int, v double").repartition(6)
    days = me.quantile_sketches(df, ["day"], "v").cache()
    for keep in ([0, 1, 2, 3, 4, 5, 6], [2, 5]):
        own = np.sort([v for i, v in enumerate(values) if i % 7 in keep and v == v])
        got = me.sketch_quantiles(days.where(days["day"].isin(keep)), [0.01, 0.5, 0.9, 0.999]).first()
        assert got.n == len(own)
        for p, q in ((0.01, got.q1), (0.5, got.q50), (0.9, got.q90), (0.999, got.q100)):
            assert abs(np.searchsorted(own, q, side="right") / len(own) - p) <= me.SKETCH_RANK_ERROR
    assert me.sketch_quantiles(days.where("day > 9"), [0.5]).count() == 0
