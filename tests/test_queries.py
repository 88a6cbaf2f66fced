"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def connection():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = connection.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, result.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["file_id", "context", "response", "split_value", "split"] and df.count() > 0


NATIVE = ["line_examples", "thread_parent", "thread_examples", "qa_examples", "split_assign", "shuffle_shards", "render",
          "serialize_features", "doc_freq", "tfidf_weights", "bm25_weights", "sample_n", "eval_batches"]


@pytest.mark.parametrize("name", NATIVE)
def test_plans_stay_in_the_jvm_and_join_on_keys(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
