import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Their plans hold tables of a fitted model, which Spark makes as it sees fit.
NOT_PLANNED = ("text_clusters", "cluster_top_words", "feature_importance", "embedding_2d", "scores_with_gaps")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name not in NOT_PLANNED:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name in SQL:
        assert differences(spark, con, SF, lambda *_: df, SQL[name]) is None
    else:
        assert df.count() > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["country", "Weighted_Score", "ramp", "is_average"]
