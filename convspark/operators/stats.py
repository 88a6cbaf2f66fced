"""Counts that tell whether a built data set agrees with the published one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from convspark.functions.split import TEST, TRAIN


def _split_counts() -> list:
    return [
        F.count(F.lit(1)).alias("examples"),
        F.count_if(F.col("split") == TRAIN).alias("train"),
        F.count_if(F.col("split") == TEST).alias("test"),
    ]


def count_examples(examples: DataFrame) -> DataFrame:
    """Number of examples, as one row."""
    return examples.agg(F.count(F.lit(1)).alias("examples"))


def split_stats(examples: DataFrame) -> DataFrame:
    """Examples in total and per split, as one row; needs the ``split`` column."""
    return examples.agg(*_split_counts())


def corpus_stats(
    inputs: DataFrame, group: str, examples: DataFrame, tuples: DataFrame | None = None
) -> DataFrame:
    """Input rows, input groups (threads, files, products), examples, train, test, as one row.

    With ``tuples``, the accepted QA tuples before de-duplication, also their number.
    """
    groups = inputs.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    before = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("inputs"), F.count(F.lit(1)).alias("groups"))
    parts = [before, split_stats(examples)]
    if tuples is not None:
        parts.insert(1, tuples.agg(F.count(F.lit(1)).alias("tuples")))
    names = [name for part in parts for name in part.columns]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.agg(*[F.max(name).alias(name) for name in names])


def observe_splits(examples: DataFrame, observation: Observation) -> DataFrame:
    """Collect :func:`split_stats` as a by-product of the job that writes the examples."""
    return examples.observe(observation, *_split_counts())
