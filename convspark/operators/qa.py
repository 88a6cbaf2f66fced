"""Question/answer records -> examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from convspark.functions.text import word_count_between


def flatten_qa(
    records: DataFrame, min_words: int | None = None, max_words: int | None = None, mark: bool = False
) -> DataFrame:
    """``(product_id, question, answer)`` rows from flat and nested records.

    With ``mark``, each record also gives a row without a question whose answer is the product.

    A flat record wins over nested questions; a record with neither gives nothing. Word bounds, when
    given, are applied inside the arrays, so a rejected question never unfolds its answers.
    """

    def accepted(c: Column) -> Column:
        if min_words is None and max_words is None:
            return c.isNotNull()
        return word_count_between(c, 0 if min_words is None else min_words, 2**31 - 1 if max_words is None else max_words)

    def pair(question: Column, answer: Column) -> Column:
        return F.struct(question.alias("question"), answer.alias("answer"))

    flat = F.array(pair(F.col("question"), F.col("answer")))
    nested = F.flatten(
        F.transform(
            F.filter("questions", lambda q: accepted(q["questionText"])),
            lambda q: F.transform(
                F.filter(q["answers"], lambda a: accepted(a["answerText"])),
                lambda a: pair(q["questionText"], a["answerText"]),
            ),
        )
    )
    flat_accepted = F.filter(flat, lambda p: accepted(p["question"]) & accepted(p["answer"]))
    pairs = F.when(F.col("question").isNotNull(), flat_accepted).otherwise(nested)
    if mark:
        product = F.array(pair(F.lit(None).cast("string"), F.col("asin")))
        pairs = F.concat(F.coalesce(pairs, F.array().cast("array<struct<question:string,answer:string>>")), product)
    return records.select(F.col("asin").alias("product_id"), F.explode(pairs).alias("pair")).select(
        "product_id", "pair.question", "pair.answer"
    )


def dedup_qa(tuples: DataFrame, *summed: str) -> DataFrame:
    """One row per (question, answer), with the smallest product id and sums of columns; combines before the shuffle."""
    sums = [F.sum(c).alias(c) for c in summed]
    return tuples.groupBy("question", "answer").agg(F.min("product_id").alias("product_id"), *sums)


def counted_qa_examples(
    records: DataFrame, min_words: int, max_words: int, before: Observation, after: Observation
) -> DataFrame:
    """:func:`qa_examples`, counting in the same pass: ``inputs``; accepted ``tuples`` and ``groups``, the products.

    The products go through the shuffle that de-duplicates the tuples, as rows without a question.
    """
    seen = records.observe(before, F.count(F.lit(1)).alias("inputs"))
    once = dedup_qa(flatten_qa(seen, min_words, max_words, mark=True).withColumn("n", F.lit(1)), "n")
    is_product = F.col("question").isNull()
    counted = once.observe(
        after,
        F.coalesce(F.sum(F.when(~is_product, F.col("n"))), F.lit(0)).alias("tuples"),
        F.count_if(is_product).alias("groups"),
    )
    return counted.where(~is_product).select("product_id", F.col("question").alias("context"), F.col("answer").alias("response"))


def qa_examples(records: DataFrame, min_words: int = 4, max_words: int = 59) -> DataFrame:
    """De-duplicated examples whose question and answer both have an accepted word count."""
    return dedup_qa(flatten_qa(records, min_words, max_words)).select(
        "product_id", F.col("question").alias("context"), F.col("answer").alias("response")
    )
