"""Inputs that once gave wrong rows or ended the job."""

import os

import pytest
from pyspark.sql import functions as F

from convspark.functions.split import split_label
from convspark.operators.evaluate import load_examples
from convspark.operators.lines import line_examples
from convspark.operators.mapping import VectorMapping
from convspark.operators.ordering import dense_index, shard_lines
from convspark.operators.qa import flatten_qa
from convspark.operators.vector import Encoder
from convspark.plans.benchmark import sweep
from convspark.schema import QA_RECORD
from convspark.sources.example_sets import read_examples, write_examples
from convspark.sources.qa_records import parse_qa_lines
from convspark.sources.text_lines import numbered_lines


def test_files_of_one_name_in_several_folders(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        for name in ("my file é.txt", "50%+1.txt"):
            text = "\n".join(f"{folder} {name} number {i}" for i in range(6))
            (tmp_path / folder / name).write_text(text)
    lines = numbered_lines(spark, str(tmp_path / "*" / "*.txt"))
    assert {r.file_id for r in lines.collect()} == {"my file é.txt", "50%+1.txt"}
    for blocks in (100_000, 2):
        found = line_examples(lines, 2, 1, 100, lines_per_block=blocks).collect()
        assert len(found) == 4 * 5
        for r in found:
            assert r.response[:-1] == r.context[:-1] and int(r.response[-1]) == int(r.context[-1]) + 1


def test_a_null_line_is_no_line(spark):
    rows = [("f", 0, "good line one"), ("f", 1, None), ("f", 2, "good line two")]
    found = line_examples(spark.createDataFrame(rows, "file_id string, line_no long, line string")).collect()
    assert [(r.context, r.response) for r in found] == [("good line one", "good line two")]


def test_shards_of_files_are_files_of_their_own(spark, tmp_path):
    (tmp_path / "x.txt").write_text("\n".join(f"line of text {i}" for i in range(40)))
    shards = shard_lines(numbered_lines(spark, str(tmp_path / "x.txt")), "line_no", lines_per_shard=10)
    assert line_examples(shards).count() == 4 * 9


def test_many_shards_get_longer_names(spark):
    rows = shard_lines(spark.range(26**3 + 1).select(F.col("id").alias("n")), "n", lines_per_shard=1)
    assert {len(r.file_id) for r in rows.select("file_id").collect()} == {len("lines-aaaa")}


def test_one_bound_of_words_is_applied(spark):
    rows = spark.createDataFrame([("p", "a b c", "a b c d e", None)], QA_RECORD)
    assert flatten_qa(rows, min_words=4).count() == 0 and flatten_qa(rows, max_words=4).count() == 0
    assert flatten_qa(rows, min_words=3).count() == 1 and flatten_qa(rows).count() == 1


def test_literals_of_wrong_types_are_set_aside(spark):
    good = r"""{'asin': 'p', 'question': u'😀?', 'answer': 'yes'}"""
    bad = [
        r"""{'asin': 'p', 'question': u'\ud800', 'answer': 'yes'}""",
        r"""{'asin': u'p', 'question': 'q', 'answer': 5}""",
        r"""{'asin': u'p', 'questions': [{'questionText': u'q', 'answers': [7]}]}""",
        r"""{'asin': u'p', 'questions': u'oops'}""",
        "no literal", "[1, 2]",
    ]
    found = parse_qa_lines(spark.createDataFrame([(x,) for x in [good, *bad]], "value string")).collect()
    assert sorted(r._corrupt for r in found if r._corrupt is not None) == sorted(bad)
    assert [r.question for r in found if r._corrupt is None] == ["\U0001F600?"]


def test_a_null_split_key_is_an_error(spark):
    with pytest.raises(Exception, match="split key is null"):
        spark.createDataFrame([(None,)], "k string").select(split_label("k")).collect()


@pytest.mark.parametrize("line", ['{"context": "a", "resp', '{"context": "only"}'])
def test_broken_examples_are_errors(spark, tmp_path, line):
    (tmp_path / "x.json").write_text('{"context": "a", "response": "b"}\n' + line + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|no response"):
        read_examples(spark, str(tmp_path), "json").collect()


def test_record_files_go_to_a_fresh_folder_only(spark, tmp_path):
    examples = spark.createDataFrame([("c", "r", "train"), ("d", "s", "test")], "context string, response string, split string")
    path = str(tmp_path / "set")
    write_examples(examples, path, "tfrecord", 2, 1)
    with pytest.raises(Exception, match="not empty"):
        write_examples(examples, path, "tfrecord", 3, 1)
    assert read_examples(spark, path, "tfrecord").count() == 2
    open(path + "/_unfinished", "w").close()
    with pytest.raises(Exception, match="unfinished"):
        read_examples(spark, path, "tfrecord").count()


def test_a_failed_write_is_not_read_and_a_repeated_task_does_no_harm(spark, tmp_path):
    failing = spark.createDataFrame([("c", "r", "train")], "context string, response string, split string").withColumn(
        "response", F.raise_error(F.lit("broken on purpose")).cast("string")
    )
    path = str(tmp_path / "failed")
    with pytest.raises(Exception, match="broken on purpose"):
        write_examples(failing, path, "tfrecord", 2, 1)
    with pytest.raises(Exception, match="unfinished|No such file"):
        read_examples(spark, path, "tfrecord").count()
    from pyspark import TaskContext

    from convspark.sources import tfrecord

    folder = str(tmp_path / "again")
    writer = tfrecord._Writer(folder, {}, False)
    TaskContext._taskContext = TaskContext()
    TaskContext._taskContext._partitionId = 3
    try:
        for _ in range(2):
            writer.write(iter([{"record": b"one"}, {"record": b"two"}]))
    finally:
        TaskContext._taskContext = None
    writer.commit([])
    assert sorted(os.listdir(folder)) == ["_SUCCESS", "part-00003.tfrecord"]


def test_the_index_runs_its_input_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    rows = spark.range(500).mapInPandas(counted, "id long")
    assert dense_index(rows).count() == 500 and runs.value == 500
    with pytest.raises(ValueError):
        dense_index(rows, prefix_digits=8)


def test_each_text_is_encoded_once_and_each_set_sampled_once(spark):
    texts = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<float>")
    def encode(column):
        import numpy as np
        import pandas as pd

        texts.add(len(column))
        return pd.Series([np.random.default_rng(len(t)).normal(size=4).astype("float32") for t in column])

    pairs = spark.range(300).selectExpr("repeat('a', cast(id + 1 as int)) context", "repeat('b', cast(id + 1 as int)) response")
    VectorMapping(Encoder(encode), (0.3,), (0.0,), max_epochs=2).search(pairs)
    assert texts.value == 600
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    from convspark.operators.keyword import TfIdf
    from convspark.params import EvalOptions

    watched = pairs.mapInPandas(counted, "context string, response string")
    rankers = {"A": TfIdf, "B": TfIdf, "C": TfIdf}
    rows = sweep({"x": (pairs, watched)}, rankers, EvalOptions(n_candidates=10), batches={"C": 2}).collect()
    assert [r.test_size for r in rows] == [300, 300, 20] and reads.value == 300


def test_loading_without_a_number_takes_all(spark):
    pairs = spark.range(50).selectExpr("string(id) context", "'r' response")
    assert sorted(r.ordinal for r in load_examples(pairs).collect()) == list(range(50))
