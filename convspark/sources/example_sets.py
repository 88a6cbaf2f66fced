"""Example sets on disk: JSON lines, TFRecord or Parquet, one folder per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.functions.examples import required, serialize_example
from convspark.operators.ordering import shuffle_into_shards
from convspark.params import FORMATS
from convspark.schema import example_schema
from convspark.sources import tfrecord


def _check_format(dataset_format: str) -> None:
    if dataset_format not in FORMATS:
        raise ValueError(f"dataset_format must be one of {FORMATS}, got {dataset_format!r}")


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without scheme lies on the cluster's default file system, as for Spark's own formats."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if "://" in path or path.startswith("file:") or default.startswith("file:"):
        return path
    return default.rstrip("/") + path


def write_examples(
    examples: DataFrame, path: str, dataset_format: str = "tfrecord", shards_train: int = 1000, shards_test: int = 100
) -> None:
    """Shuffle and write both splits in one job: ``shards_train`` plus ``shards_test`` files.

    ``examples`` has a ``split`` column. JSON and Parquet go to ``split=train`` and ``split=test``;
    record files are named by split and shard. Null features are absent from the output.
    """
    _check_format(dataset_format)
    shuffled = shuffle_into_shards(examples, shards_train, shards_test)
    if dataset_format != "tfrecord":
        shuffled.write.partitionBy("split").format(dataset_format).save(path)
        return
    tfrecord.register(examples.sparkSession)
    features = [c for c in examples.columns if c != "split"]
    (
        shuffled.select("split", serialize_example(features).alias("record"))
        .write.format("tfrecord")
        .mode("append")
        .option("train", shards_train)
        .option("test", shards_test)
        .save(_qualified(examples.sparkSession, path))
    )


def read_examples(
    spark: SparkSession,
    path: str,
    dataset_format: str = "tfrecord",
    num_extra_contexts: int = 10,
    other_features: tuple[str, ...] = (),
) -> DataFrame:
    """Examples at a folder or file pattern, absent extra features null.

    Raises when there is nothing to read, and when a line or record is no example with a context and a
    response.
    """
    _check_format(dataset_format)
    schema = example_schema(num_extra_contexts, other_features)
    # a line that is no example stops the job
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if dataset_format == "tfrecord":
        tfrecord.register(spark)
        return required(spark.read.schema(schema).format("tfrecord").load(_qualified(spark, path)))
    found = reader.format(dataset_format).load(path)
    if not found.inputFiles():
        raise FileNotFoundError(f"no example files below {path}")
    return required(found.select(*[F.col(f"`{name}`") for name in schema.fieldNames()]))


def append_results(results: DataFrame, path: str) -> None:
    """Append evaluation rows as CSV with a header."""
    results.write.mode("append").option("header", True).csv(path)
