"""1-of-N evaluation: loading, batches, accuracy, recall."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convspark.operators.ordering import dense_index, row_digest
from convspark.params import check_positive


def dedup_contexts(examples: DataFrame, seed: int = 0) -> DataFrame:
    """One example per distinct context: the first in seeded hash order."""
    order = Window.partitionBy("context").orderBy(row_digest(["context", "response"], seed), "response")
    return examples.withColumn("_seen", F.row_number().over(order)).where("_seen = 1").drop("_seen")


def load_examples(
    examples: DataFrame, n: int | None = None, seed: int = 0, deduplicate: bool = False
) -> DataFrame:
    """All, or up to n random ``(context, response, ordinal)`` rows, ``ordinal`` dense from 0."""
    pairs = examples.select("context", "response")
    if deduplicate:
        pairs = dedup_contexts(pairs, seed)
    return dense_index(pairs, seed, limit=n, unique=deduplicate)


def eval_batches(indexed: DataFrame, n_candidates: int = 100, seed: int = 0) -> DataFrame:
    """Full batches of N consecutive rows of a densely indexed set.

    Adds ``batch_id``, ``true_pos`` (place of the row's response among the candidates) and
    ``ctx_pos`` (place of its context after a random permutation, so that ties cannot help).
    Rows past the last full batch are dropped, as accuracy is defined on full batches. A window
    here spans one batch, N rows.
    """
    check_positive(n_candidates=n_candidates)
    batch = Window.partitionBy("batch_id")
    permuted = batch.orderBy(F.md5(F.concat_ws(":", F.lit(f"permute-{seed}"), F.col("true_pos").cast("string"),
                                               F.col("batch_id").cast("string"))), "true_pos")
    return (
        indexed.withColumn("batch_id", F.floor(F.col("ordinal") / n_candidates))
        .withColumn("true_pos", (F.col("ordinal") % n_candidates).cast("int"))
        .drop("ordinal")
        .withColumn("_size", F.count(F.lit(1)).over(batch))
        .where(F.col("_size") == n_candidates)
        .drop("_size")
        .withColumn("ctx_pos", (F.row_number().over(permuted) - 1).cast("int"))
    )


def recall_at_k(ranked: DataFrame, k: int = 1) -> DataFrame:
    """Percentage of contexts whose own response is among the k best; null without any batch."""
    check_positive(k=k)
    per_batch = ranked.groupBy("batch_id").agg(
        F.avg((F.col("true_rank") <= k).cast("double")).alias("share"), F.count(F.lit(1)).alias("rows")
    )
    return per_batch.agg(
        (F.lit(100.0) * F.avg("share")).alias("accuracy"),
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("contexts"),
    )


def accuracy(ranked: DataFrame) -> DataFrame:
    """1-of-N accuracy in percent: the best-scored response is the context's own."""
    return recall_at_k(ranked, 1)
