"""Deterministic train/test split by a hash of the group key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published split: md5 modulo this many buckets.
NUM_BUCKETS = 4096
_HEX_DIGITS = 3  # 16 ** 3 == NUM_BUCKETS, so the modulo is the last three hex digits

TRAIN = "train"
TEST = "test"


def split_value(key: Column | str) -> Column:
    """A value in (0, 1] that depends only on the key: (1 + md5(key) mod 4096) / 4096."""
    digest = F.md5(key if isinstance(key, Column) else F.col(key))
    bucket = F.conv(F.right(digest, F.lit(_HEX_DIGITS)), 16, 10).cast("int")
    return (F.lit(1) + bucket) / F.lit(float(NUM_BUCKETS))


def split_label(key: Column | str, train_split: float = 0.9) -> Column:
    """``train`` where the split value is strictly below ``train_split``, else ``test``; a null key is an error."""
    value = F.coalesce(split_value(key), F.raise_error(F.lit("a split key is null")).cast("double"))
    return F.when(value < F.lit(float(train_split)), TRAIN).otherwise(TEST)


def assign_split(df: DataFrame, key: str, train_split: float = 0.9) -> DataFrame:
    """Add a ``split`` column; all rows of one key get the same label."""
    return df.withColumn("split", split_label(key, train_split))
