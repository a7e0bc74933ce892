"""The keyed permutation: a bijection, the same in Python, Spark and SQL."""
import duckdb
import pytest
from pyspark.sql import functions as F

from txnscope.functions import permutation as P


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 100, 101, 1000, 1023])
def test_every_place_is_taken_once(spark, n):
    rows = spark.range(n).select("id", P.keyed_position(F.col("id"), n, 7).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.p == P.permuted(r.id, n, 7) for r in rows)


def test_order_is_mixed_and_depends_on_the_key(spark):
    n = 2000
    a, b = ([P.permuted(i, n, s) for i in range(n)] for s in (1, 2))
    assert a != b and sum(x == i for i, x in enumerate(a)) < 10
    rise = sum(y > x for x, y in zip(a, a[1:]))
    assert 900 < rise < 1100                                 # neighbours do not stay in order
    first = [i for i, x in enumerate(a) if x < 500]
    assert abs(sum(first) / 500 - 1000) < 100 and len(first) == 500


@pytest.mark.parametrize("n", [1, 7, 100, 999])
def test_sql_gives_the_same_places(n):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT i AS k FROM range({n}) r(i)")
    got = con.execute(P.permutation_sql("t", "k", "(SELECT count(*) FROM t)", 42, 8)).fetchall()
    assert {k: p for k, p in got} == {i: P.permuted(i, n, 42) for i in range(n)}


def test_first_n_with_and_without_gaps_in_the_ids(spark):
    dense = spark.range(50, 150).withColumnRenamed("id", "txn_id")
    gaps = dense.selectExpr("txn_id * txn_id AS txn_id").repartition(6)
    text = dense.selectExpr("concat('t', lpad(txn_id, 5, '0')) AS txn_id").repartition(3)
    by_rank = []
    for df in (dense, gaps, text):
        got = sorted(r.txn_id for r in P.first_n_shuffled(df, 30).collect())
        every = sorted(r.txn_id for r in df.collect())
        assert got == [v for i, v in enumerate(every) if P.permuted(i, 100, 42) < 30] and len(got) == 30
        by_rank.append([every.index(v) for v in got])
    assert by_rank[0] == by_rank[1] == by_rank[2]
    assert P.first_n_shuffled(dense, 1000).count() == 100 and P.first_n_shuffled(dense, 0).count() == 0
    assert P.first_n_shuffled(dense.where("txn_id < 0"), 5).count() == 0


def test_positions_outside_the_table_have_no_place(spark):
    df = spark.createDataFrame([(None,), (-1,), (5,), (4,)], "x bigint")
    assert [r.p is None for r in df.select(P.keyed_position(F.col("x"), 5).alias("p")).collect()] == [True, True, True, False]
