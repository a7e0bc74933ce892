"""Exact money / percentage rounding (half-up on exact totals)."""
from pyspark.sql import functions as F

from txnscope.functions import exact


def test_money_avg_half_up_ties(spark):
    df = spark.createDataFrame([(1, 0.01), (1, 0.02), (2, 7777.66), (2, 7777.67), (3, 2.5)],
                               "g int, amount double")
    out = {r.g: (r.a, r.s) for r in df.groupBy("g").agg(exact.money_avg("amount").alias("a"),
                                                         exact.money_sum("amount").alias("s"))
           .collect()}
    assert out[1] == (0.02, 0.03)          # 0.015 -> 0.02
    assert out[2][0] == 7777.67            # 7777.665 -> 7777.67
    assert out[3] == (2.5, 2.5)


def test_pct_half_up_and_zero_denominator(spark):
    df = spark.createDataFrame([(1, 128), (0, 0), (1, 3), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(exact.pct(F.col("n"), F.col("d"), 4)).collect()]
    assert got == [0.7813, 0.0, 33.3333, 66.6667]


def test_negative_money_mean(spark):
    df = spark.createDataFrame([(-0.01,), (-0.02,)], "amount double")
    assert df.agg(exact.money_avg("amount")).first()[0] == -0.02
