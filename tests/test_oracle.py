"""Every registered query against its SQL twin in DuckDB (sf0.001, whole tables)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQLS[name]).df()
    assert compare(got, want) is None, compare(got, want)


def test_every_query_has_sql_or_is_listed():
    no_sql = {k for k in set(QUERIES) - set(SQLS) if not k.startswith("op") and k != "pipeline"}
    assert no_sql == {"p7_seeded_shuffle", "w9_bounded_replay_choice", "m1_split_sides", "m2_smote_training_set",
                      "m3_scaled_test_features", "m15_batch_scores", "m17_model_comparison"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5
    assert df.columns == ["type", "count", "total_amount", "avg_amount", "min_amount",
                          "max_amount", "fraud_count", "fraud_percentage"]
