from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from convspark import workspace


def test_tables_go_below_the_configured_folder(spark):
    assert workspace.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/convspark/x-")
    table, n = workspace.materialise_counting(spark.range(10).withColumn("context/0", F.lit("t")), "x", F.col("id") > 6)
    assert (table.count(), n, table.columns) == (10, 3, ["id", "context/0"])
    empty, n = workspace.materialise_counting(spark.range(10).where("id > 20"), "x")
    assert (empty.count(), n) == (0, 0)


def session(master, configured=None, application="app"):
    context = SimpleNamespace(master=master, applicationId=application, getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default=None: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.work_dir(session("yarn"))
    assert workspace.work_dir(session("yarn", "hdfs://name/shared/")) == "hdfs://name/shared/convspark"


def test_a_local_session_gets_a_folder_of_its_own():
    first = workspace.work_dir(session("local[2]"))
    assert first == workspace.work_dir(session("local[2]")) != workspace.work_dir(session("local[2]", None, "other"))


def test_broadcast_depends_on_the_size(spark):
    df = spark.range(3)
    assert workspace.broadcast_if_small(df, workspace.BROADCAST_ROWS + 1) is df
    assert "broadcast" in workspace.broadcast_if_small(df, 3)._jdf.queryExecution().toString().lower()
