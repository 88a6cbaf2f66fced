"""Whole jobs from files: counts, rejected lines, tables by name, and what is left behind."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.operators.qa import flatten_qa
from convspark.operators.stats import corpus_stats
from convspark.params import LineOptions, QaOptions, ThreadOptions
from convspark.plans.datasets import build_line_dataset, build_qa_dataset, build_thread_dataset, qa_dataset, thread_dataset
from convspark.schema import QA_RECORD
from convspark.sources.comments import read_catalog_tables, read_tables, reconcile
from convspark.sources.text_lines import numbered_lines, read_lines
from convspark.workspace import job_scope, materialise, work_dir
from queries import sources
from tests.test_qa import RECORDS
from tests.test_threads import simple


def left_behind(spark):
    return set(os.listdir(work_dir(spark))) if os.path.isdir(work_dir(spark)) else set()


def test_lines_that_are_no_text_are_set_aside(spark, tmp_path):
    rng = random.Random(3)
    written, bad = {}, {}
    for name in ("a.txt", "b +%.txt"):
        lines = [b"plain %d" % i if rng.random() < 0.8 else b"caf\xe9 %d" % i for i in range(500)]
        (tmp_path / name).write_bytes(b"\n".join(lines))
        written[name] = [(i, x.decode()) for i, x in enumerate(lines) if b"\xe9" not in x]
        bad[name] = [(i, x) for i, x in enumerate(lines) if b"\xe9" in x]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = read_lines(spark, str(tmp_path / "*.txt"))
        for name in written:
            here = F.col("file_id") == name
            assert sorted((r.line_no, r.line) for r in found.lines.where(here).collect()) == written[name]
            assert sorted((r.line_no, bytes(r.raw)) for r in found.rejects.where(here).collect()) == bad[name]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found.counts == {"inputs": 1000, "groups": 2, "rejects": sum(map(len, bad.values()))}
    with pytest.raises(ValueError, match="not valid UTF-8, such as line"):
        numbered_lines(spark, str(tmp_path / "*.txt"))


def test_a_line_job_counts_what_it_reads_and_leaves_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / "in" / f"f{k}").write_bytes(b"\n".join([b"a good line number %d" % i for i in range(20)] + [b"\xff"] * (k % 2)))
    before = left_behind(spark)
    path = str(tmp_path / "set")
    counts = build_line_dataset(spark, str(tmp_path / "in" / "*"), path, LineOptions(num_shards_train=2, num_shards_test=1, train_split=0.5, dataset_format="json"))
    assert counts | {"train": 0, "test": 0} == {"inputs": 123, "groups": 6, "rejects": 3, "examples": 6 * 19, "train": 0, "test": 0}
    assert counts["train"] + counts["test"] == counts["examples"]
    assert left_behind(spark) == before
    rejects = spark.read.parquet(path + "-rejects").collect()
    assert sorted((r.file_id, r.line_no, r.reason) for r in rejects) == [(f"f{k}", 20, "not valid UTF-8") for k in (1, 3, 5)]
    # without a bad line there is no table of them
    assert build_line_dataset(spark, str(tmp_path / "in" / "f0"), str(tmp_path / "clean"), LineOptions(num_shards_train=1, num_shards_test=1))["rejects"] == 0
    assert not os.path.exists(tmp_path / "clean-rejects")


def test_a_qa_job_counts_like_the_statistics(spark, tmp_path):
    lines = [repr(r) for r in RECORDS for _ in range(2)]
    (tmp_path / "in.json").write_bytes("\n".join([*lines[:5], "no literal", *lines[5:]]).encode() + b"\n\xfe\xfe")
    options = QaOptions(3, 5, 0.5, 2, 2, "json")
    path = str(tmp_path / "set")
    counts = build_qa_dataset(spark, str(tmp_path / "in.json"), path, options)
    records = spark.createDataFrame([r for r in RECORDS for _ in range(2)], QA_RECORD)
    stats = corpus_stats(records, "asin", qa_dataset(records, options), flatten_qa(records, 3, 5)).first().asDict()
    assert counts == {**stats, "rejects": 2}
    rejects = sorted((r.line_no, r.reason, bytes(r.raw)) for r in spark.read.parquet(path + "-rejects").collect())
    assert rejects == [(5, "no record", b"no literal"), (len(lines) + 1, "not valid UTF-8", b"\xfe\xfe")]


def test_a_thread_job_reads_its_comments_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(body):
        reads.add(1)
        return body

    comments = simple(spark, "t3_thread-A", "t3_testthread").cache()
    options = ThreadOptions(min_length=4, max_length=5, train_split=0.5, num_shards_train=1, num_shards_test=1, dataset_format="json")
    counts = build_thread_dataset(comments.withColumn("body", counted("body")), str(tmp_path / "set"), options)
    stats = corpus_stats(comments, "link_id", thread_dataset(comments, options)).first().asDict()
    assert counts == stats and reads.value == stats["inputs"]


def test_scopes_delete_their_own_tables_even_after_an_error(spark):
    before = left_behind(spark)
    with pytest.raises(RuntimeError):
        with job_scope(spark):
            materialise(spark.range(3), "outer")
            with job_scope(spark):
                materialise(spark.range(3), "inner")
            assert [n.split("-")[0] for n in left_behind(spark) - before] == ["outer"]
            raise RuntimeError
    assert left_behind(spark) == before
    kept = materialise(spark.range(3), "kept")
    assert kept.count() == 3 and len(left_behind(spark) - before) == 1


def month(spark, root, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}")


def test_tables_of_matching_names_are_one(spark, tmp_path):
    root = str(tmp_path / "root (x)")
    month(spark, root, "2015_01", [("a", 1)], "id string, score int")
    month(spark, root, "2015_02", [("b", 2)], "id string, score int")
    month(spark, root, "2016_10", [(1.5, "c")], "score double, id string")
    month(spark, root, "2017_11", [("d", "s")], "id string, subreddit string")
    month(spark, root, "2014_01", [("old", 1)], "id string, score int")
    month(spark, root, "2018_01_backup", [("copy", 1)], "id string, score int")
    found = read_tables(spark, root)
    assert found.columns == ["id", "score", "subreddit", "month"] and dict(found.dtypes)["score"] == "double"
    rows = sorted((r.month, r.id, r.score, r.subreddit) for r in found.collect())
    assert rows == [("2015_01", "a", 1.0, None), ("2015_02", "b", 2.0, None), ("2016_10", "c", 1.5, None), ("2017_11", "d", None, "s")]
    # tables of one schema are one scan, and others are not in the plan at all
    assert {f.split("/")[-2] for f in found.inputFiles()} == {"2015_01", "2015_02", "2016_10", "2017_11"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3
    with pytest.raises(FileNotFoundError, match="no table"):
        read_tables(spark, root, "^1999")


def test_tables_of_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS months")
    try:
        for name in ("2015_01", "2015_02", "2019_01"):
            spark.sql(f"CREATE TABLE months.`{name}` USING parquet AS SELECT '{name}' AS id")
        rows = sorted((r.month, r.id) for r in read_catalog_tables(spark, "months").collect())
        assert rows == [("2015_01", "2015_01"), ("2015_02", "2015_02")]
    finally:
        spark.sql("DROP DATABASE months CASCADE")


def test_types_that_differ_become_one_that_holds_both():
    def schema(kind):
        return T.StructType([T.StructField("x", kind)])

    cases = [
        (T.ByteType(), T.IntegerType(), T.IntegerType()), (T.LongType(), T.FloatType(), T.DoubleType()),
        (T.DoubleType(), T.ShortType(), T.DoubleType()), (T.IntegerType(), T.StringType(), T.StringType()),
        (T.DateType(), T.TimestampType(), T.StringType()), (T.StringType(), T.StringType(), T.StringType()),
    ]
    for a, b, common in cases:
        assert reconcile([schema(a), schema(b)])["x"].dataType == common == reconcile([schema(b), schema(a)])["x"].dataType


def test_each_line_file_is_written_by_a_task_of_its_own(spark, monkeypatch):
    """Two of six files, a third of the input, met in one task."""
    monkeypatch.setattr(sources, "_renamed", lambda spark, path, names: path)
    path = sources._line_files(spark, "/root/testdata/sf0.01").removeprefix("file:")
    parts = [p.name.split("-")[1] for p in Path(path).glob("folder=*/file=*/part-*")]
    assert len(parts) == 6 and len(set(parts)) == 6
