import glob
import os
import random

import pytest

from pyspark.sql import functions as F

from convspark.functions.examples import fixed_width, mix, render_example, serialize_example
from convspark.operators.stats import corpus_stats, count_examples
from convspark.params import EvalOptions, LineOptions, QaOptions, ThreadOptions
from convspark.plans.datasets import line_dataset, write_dataset
from convspark.schema import LINES, example_schema
from convspark.sources import tfrecord
from convspark.sources.comments import union_months
from convspark.sources.example_sets import append_results, read_examples, write_examples

COLUMNS = "context string, response string, `context/0` string, `context/1` string, file_id string, split string"
ROWS = [
    ("c1", "r1", None, None, "f", "train"),
    ("c2 é中", "r2", "", None, "f", "train"),
    ("c3\nline", "r3" * 400, "x0", "x1", "g", "test"),
    ("c4", "", "x0", None, "f", "train"),
]


@pytest.fixture
def examples(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.mark.parametrize("dataset_format", ["json", "tfrecord", "parquet"])
def test_round_trip(spark, tmp_path, dicts, examples, dataset_format):
    path = str(tmp_path / dataset_format)
    write_examples(examples, path, dataset_format, 2, 1)
    found = read_examples(spark, path, dataset_format, 2, ("file_id",))
    assert dicts(found) == dicts(examples.drop("split"))


def test_record_files_are_named_by_split_and_shard(spark, tmp_path, examples):
    path = str(tmp_path / "named")
    write_examples(examples, path, "tfrecord", 3, 2)
    names = sorted(os.path.basename(f) for f in glob.glob(path + "/*.tfrecord"))
    assert names == [
        *[f"test-{i:05d}-of-00002.tfrecord" for i in range(2)],
        *[f"train-{i:05d}-of-00003.tfrecord" for i in range(3)],
    ]
    assert sorted(os.listdir(path)) == ["_SUCCESS", *names]


def test_file_patterns(spark, tmp_path, examples):
    path = str(tmp_path / "patterns")
    write_examples(examples, path, "tfrecord", 3, 1)
    write_examples(examples, path + "-json", "json", 3, 1)
    for found in (
        read_examples(spark, path + "/train-*", "tfrecord"),
        read_examples(spark, "file://" + path + "/train-0000?-of-*.tfrecord", "tfrecord"),
        read_examples(spark, path + "-json/split=train/*.json", "json"),
    ):
        assert sorted(r.context for r in found.collect()) == ["c1", "c2 é中", "c4"]
    with pytest.raises(Exception, match="no record files"):
        read_examples(spark, path + "/dev-*", "tfrecord").count()


def test_json_leaves_absent_features_out(spark, tmp_path, examples):
    path = str(tmp_path / "json")
    write_examples(examples, path, "json", 1, 1)
    lines = [line for f in glob.glob(path + "/split=train/*.json") for line in open(f, encoding="utf-8")]
    assert sorted(lines)[0] == '{"context":"c1","response":"r1","file_id":"f"}\n'
    assert len(lines) == 3 and sum('"context/0":""' in line for line in lines) == 1


def test_number_of_files_is_the_number_of_shards(spark, tmp_path):
    df = spark.range(3000).select(
        F.concat(F.lit("c"), "id").alias("context"), F.lit("r").alias("response"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
    )
    for dataset_format in ("json", "tfrecord"):
        path = str(tmp_path / dataset_format)
        write_examples(df, path, dataset_format, 6, 2)
        found = [f[len(path):] for f in glob.glob(path + "/**/*." + dataset_format, recursive=True)]
        assert sum("train" in f for f in found) == 6 and sum("test" in f for f in found) == 2


def test_nothing_to_read_is_an_error(spark, tmp_path):
    for dataset_format in ("json", "tfrecord"):
        with pytest.raises(Exception):
            read_examples(spark, str(tmp_path / "missing"), dataset_format).count()
    with pytest.raises(ValueError):
        read_examples(spark, str(tmp_path), "xml")


def test_checksums(tmp_path):
    # published check value of CRC-32C, and the mask rule applied to it
    crc = 0xE3069283
    masked = (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    assert tfrecord.masked_crc32c([b"", b"123456789", b"1234"])[1] == masked
    data = tfrecord.frame([b"one", b"", b"three" * 100])
    path = tmp_path / "x.tfrecord"
    path.write_bytes(data)
    with open(path, "rb") as f:
        assert list(tfrecord.unframe(f)) == [[b"one", b"", b"three" * 100]]
    for broken in (data[:-1], data[:12] + b"X" + data[13:]):
        path.write_bytes(broken)
        with open(path, "rb") as f, pytest.raises(ValueError):
            list(tfrecord.unframe(f))


def test_serialized_bytes(spark):
    # Hand-written message: features { feature { key: "a" value { bytes_list { value: "hi" } } } }
    df = spark.createDataFrame([("hi", None), ("h" * 300, None), ("h" * 20000, "b")], "a string, b string")
    rows = [bytes(r[0]) for r in df.select(serialize_example(["b", "a"])).collect()]
    assert rows[0] == bytes.fromhex("0a0d" "0a0b" "0a0161" "1206" "0a04" "0a026869")
    assert [tfrecord.parse_example(r) for r in rows] == [{"a": "hi"}, {"a": "h" * 300}, {"a": "h" * 20000, "b": "b"}]


def test_fixed_width_fills_with_empty_text(examples):
    rows = fixed_width(examples, 3)
    assert rows.columns == ["context", "response", "context/0", "context/1", "context/2"]
    assert sorted(map(tuple, rows.collect()))[0] == ("c1", "r1", "", "", "")


@pytest.mark.parametrize("column", ["context", "response"])
def test_fixed_width_needs_a_context_and_a_response(examples, column):
    with pytest.raises(Exception, match=f"no {column}"):
        fixed_width(examples.withColumn(column, F.nullif(column, F.lit("c1" if column == "context" else "r1"))), 2).collect()


def test_mix_of_different_depths(spark, examples):
    deeper = spark.createDataFrame([("c", "r", "z", "p")], "context string, response string, `context/5` string, product_id string")
    mixed = mix(examples, deeper)
    assert mixed.count() == 5 and mixed.where("`context/5` is null").count() == 4


def test_months_prune_partitions(spark, tmp_path):
    months = ["2014_12", "2015_01", "2017_06", "2018_12", "2019_01", "2015_012"]
    spark.createDataFrame([(m, i) for i, m in enumerate(months)], "month string, id int").write.partitionBy(
        "month"
    ).parquet(str(tmp_path / "m"))
    found = union_months(spark.read.parquet(str(tmp_path / "m")))
    assert sorted(r.month for r in found.collect()) == ["2015_01", "2017_06", "2018_12"]
    assert "PartitionFilters: [isnotnull(month" in found._jdf.queryExecution().executedPlan().toString()


def test_render(spark):
    schema = example_schema(3, ("thread_id", "subreddit"))
    df = spark.createDataFrame([("a\nb", "r", "x0", "x1", None, "t", "s"), ("c", "r", None, "gap", None, "t", "s")], schema)
    texts = [r[0] for r in df.select(render_example(df.columns)).collect()]
    other = "\nOther features:\n\t[subreddit]:\n\t\ts\n\t[thread_id]:\n\t\tt\n"
    extra = "\nExtra Contexts:\n\t[context/1]:\n\t\tx1\n\t[context/0]:\n\t\tx0\n"
    assert texts[0] == "[Context]:\n\ta\\n b\n[Response]:\n\tr\n" + extra + other
    assert texts[1] == "[Context]:\n\tc\n[Response]:\n\tr\n" + other


def test_write_dataset_reports_its_counts(spark, tmp_path):
    lines = spark.createDataFrame([(f"f{i // 50}", i, f"this is line number {i}") for i in range(1000)], LINES)
    options = LineOptions(num_extra_contexts=2, num_shards_train=2, num_shards_test=1, dataset_format="json")
    dataset = line_dataset(lines, options)
    counts = write_dataset(dataset, str(tmp_path / "set"), options)
    stats = corpus_stats(lines, "file_id", dataset).first().asDict()
    assert counts == {k: stats[k] for k in ("examples", "train", "test")}
    assert stats["inputs"] == 1000 and stats["groups"] == 20 and stats["examples"] == 20 * 49
    assert stats["train"] + stats["test"] == stats["examples"]
    assert count_examples(read_examples(spark, str(tmp_path / "set"), "json", 2)).first()[0] == stats["examples"]


def test_results_are_appended(spark, tmp_path):
    row = spark.createDataFrame([("BM25", 1.5)], "method string, accuracy double")
    append_results(row, str(tmp_path / "r"))
    append_results(row, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 2


def test_options():
    assert (ThreadOptions().num_shards_train, QaOptions().num_shards_test, EvalOptions().n_candidates) == (1000, 10, 100)
    for bad in (lambda: ThreadOptions(parent_depth=0), lambda: LineOptions(min_length=-1), lambda: QaOptions(max_words=2.5),
                lambda: LineOptions(dataset_format="xml")):
        with pytest.raises(ValueError):
            bad()


def framed(path, records):
    with open(path, "wb") as f:
        f.write(tfrecord.frame(records))
    return os.path.getsize(path)


def loaded(spark, path, split_bytes):
    tfrecord.register(spark)
    return spark.read.format("tfrecord").option("splitBytes", split_bytes).load(str(path))


@pytest.mark.parametrize("split_bytes", [0, 1, 7, 64, 1000, 10**9])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    records = [rng.randbytes(rng.choice([0, 1, 8, 30, 300])) for _ in range(40)] + [bytes(50), b"\0" * 12, b""]
    size = framed(tmp_path / "a.tfrecord", records)
    framed(tmp_path / "b.tfrecord", [])
    found = loaded(spark, tmp_path, split_bytes)
    assert sorted(bytes(r.record) for r in found.collect()) == sorted(records)
    # an empty file is a range too
    assert found.rdd.getNumPartitions() == (-(-size // split_bytes) if split_bytes else 1) + 1


def test_a_large_file_is_spread_over_tasks(spark, tmp_path):
    rng = random.Random(1)
    records = [b"%08d" % i + rng.randbytes(2_000) * rng.choice([1, 1, 1, 60]) for i in range(4_000)]
    size = framed(tmp_path / "large.tfrecord", records)
    found = loaded(spark, tmp_path, 4 << 20).select(F.substring("record", 1, 8).cast("string").cast("int").alias("n"), F.length("record").alias("size"))
    assert found.rdd.getNumPartitions() == -(-size // (4 << 20)) > 15
    per_task = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 15
    assert found.agg(F.count("*"), F.count_distinct("n"), F.sum("size")).first() == (4_000, 4_000, sum(map(len, records)))


def test_records_that_hold_records(spark, tmp_path):
    """Frames inside a record look like those of the file: either they are not met, or that is an error."""
    inner = tfrecord.frame([b"x" * 40] * 5)
    framed(tmp_path / "nested.tfrecord", [inner, inner, b"plain" * 20])
    assert loaded(spark, tmp_path, 0).count() == 3
    with pytest.raises(Exception, match="splitBytes 0"):
        loaded(spark, tmp_path, 70).count()


@pytest.mark.parametrize("split_bytes", [0, 100])
def test_damage_is_found_in_any_range(spark, tmp_path, split_bytes):
    framed(tmp_path / "x.tfrecord", [b"abc" * 30] * 20)
    data = bytearray((tmp_path / "x.tfrecord").read_bytes())
    data[1000] ^= 1
    (tmp_path / "x.tfrecord").write_bytes(data)
    with pytest.raises(Exception, match="checksum|hold records"):
        loaded(spark, tmp_path, split_bytes).count()
