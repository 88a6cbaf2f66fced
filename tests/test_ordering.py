import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from convspark.operators import ordering
from convspark.operators.ordering import dense_index, ordered_index, sample_n, shard_lines, shuffle_into_shards


def test_dense_index_is_dense_and_reproducible(spark):
    df = spark.range(5000).withColumn("t", F.md5(F.col("id").cast("string")))
    first = {r.id: r.ordinal for r in dense_index(df, seed=1).collect()}
    assert sorted(first.values()) == list(range(5000))
    again = {r.id: r.ordinal for r in dense_index(df.repartition(3), seed=1, unique=True).collect()}
    assert again == first
    assert {r.id: r.ordinal for r in dense_index(df, seed=2).collect()} != first


def test_copies_all_get_an_index(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_COPIES_PER_BLOCK", 7)
    df = spark.createDataFrame([("hot",)] * 300 + [("rare",)] * 5 + [(str(i),) for i in range(50)], "t string")
    rows = dense_index(df).collect()
    assert sorted(r.ordinal for r in rows) == list(range(355))
    assert Counter(r.t for r in rows)["hot"] == 300
    hot = sorted(r.ordinal for r in rows if r.t == "hot")
    assert hot == list(range(hot[0], hot[0] + 300))
    for n in (0, 1, 299, 340, 355, 400):
        assert sample_n(df, n).count() == min(n, 355)


def test_sample_is_a_subset_without_replacement(spark):
    df = spark.range(3000)
    rows = [r.id for r in sample_n(df, 100, seed=4).collect()]
    assert len(set(rows)) == 100
    assert set(rows) != {r.id for r in sample_n(df, 100, seed=5).collect()}
    assert {r.id for r in sample_n(df, 50, seed=4).collect()} < set(rows)


def test_sample_drops_buckets_before_the_shuffle(spark):
    plan = sample_n(spark.range(100000).withColumn("t", F.lit("x")), 10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_ordered_index(spark):
    ids = list(range(2000))
    random.Random(0).shuffle(ids)
    df = spark.createDataFrame([(f"f{i % 3}", i) for i in ids], "file string, n long").repartition(5)
    rows = ordered_index(df, "file", "n").collect()
    assert [(r.file, r.n) for r in sorted(rows, key=lambda r: r.ordinal)] == sorted((f"f{i % 3}", i) for i in ids)
    assert sorted(r.ordinal for r in rows) == list(range(2000))


def test_shard_names_count_in_letters(spark):
    df = spark.range(700).select(F.col("id").alias("n"), F.lit("text").alias("line"))
    rows = {r.n: (r.file_id, r.line_no) for r in shard_lines(df, "n", lines_per_shard=1).collect()}
    assert (rows[0], rows[1], rows[25], rows[26], rows[699]) == (
        ("lines-aaa", 0), ("lines-aab", 0), ("lines-aaz", 0), ("lines-aba", 0), ("lines-bax", 0)
    )
    by_hundred = shard_lines(df, "n", lines_per_shard=100).groupBy("file_id").agg(F.min("line_no"), F.max("line_no"))
    assert sorted(map(tuple, by_hundred.collect())) == [(f"lines-aa{c}", 0, 99) for c in "abcdefg"]


def test_running_out_of_shard_names_is_an_error(spark):
    df = spark.range(27).select(F.col("id").alias("n"))
    with pytest.raises(Exception, match="raise suffix_length"):
        shard_lines(df, "n", lines_per_shard=1, suffix_length=1).collect()


def test_shards_are_even_even_for_copies(spark):
    df = spark.createDataFrame([("hot", "train")] * 4000 + [(str(i), "train") for i in range(2000)]
                               + [(str(i), "test") for i in range(900)], "t string, split string")
    shuffled = shuffle_into_shards(df, 4, 3)
    assert shuffled.rdd.getNumPartitions() == 7
    rows = shuffled.withColumn("p", F.spark_partition_id()).collect()
    assert Counter((r.t, r.split) for r in rows) == Counter((r.t, r.split) for r in df.collect())
    sizes = Counter((r.split, r.p) for r in rows)
    assert {k for k in sizes} == {("train", p) for p in range(4)} | {("test", p) for p in range(4, 7)}
    assert all(abs(n - (1500 if s == "train" else 300)) < 200 for (s, _), n in sizes.items())
    hot = Counter(r.p for r in rows if r.t == "hot")
    assert min(hot.values()) > 800
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert plan[plan.index("Initial Plan"):].count("Exchange ") == 1


@pytest.mark.parametrize("n", [0, 1, 250, 299, 900, 5000])
def test_cutting_in_every_task_changes_no_sample(spark, monkeypatch, n):
    rows = [("hot", 1)] * 300 + [(f"t{i}", i) for i in range(700)] + [(None, 0)] * 3
    df = spark.createDataFrame(rows, "t string, i int").repartition(6)
    once = sorted(map(tuple, dense_index(df, 3, limit=n).collect()), key=str)
    monkeypatch.setattr(ordering, "ONE_PASS_ROWS", -1)
    assert once == sorted(map(tuple, dense_index(df, 3, limit=n).collect()), key=str) and len(once) == min(n, 1003)


def test_a_sample_runs_its_input_once_and_moves_little(spark, monkeypatch):
    runs, plans = spark.sparkContext.accumulator(0), []
    whole = ordering.materialise
    monkeypatch.setattr(
        ordering, "materialise", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), whole(df, label))[1]
    )

    @F.udf("long")
    def counted(i):
        runs.add(1)
        return i

    df = spark.range(0, 40_000, 1, 8).select(counted("id").alias("n"))
    assert sample_n(df, 1500, seed=4).count() == 1500
    assert runs.value == 40_000
    [plan] = plans
    assert plan.count("WindowGroupLimit") >= 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange ")
    assert spark.conf.get(ordering._GROUP_LIMIT) == "1000"
