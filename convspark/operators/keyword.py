"""Keyword rankers: TF-IDF and BM25 over exact terms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convspark.functions.text import token_counts, tokens
from convspark.operators.scoring import (
    BLOCK,
    RANKED,
    batches_together,
    grouped_scores,
    in_blocks,
    merge_blocks,
    pack_of,
    partial_ranks,
    rank_scores,
    sparse_scores,
)
from convspark.workspace import BROADCAST_ROWS, broadcast_if_small, materialise_counting


def documents(examples: DataFrame) -> DataFrame:
    """Contexts and responses as one set of documents."""
    return examples.select(F.explode(F.array("context", "response")).alias("text"))


def document_frequency(docs: DataFrame) -> DataFrame:
    """``(term, df)``: in how many documents a term occurs; partial counts before the shuffle."""
    return (
        docs.select(F.explode(F.array_distinct(tokens("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def term_counts(docs: DataFrame, *key: str) -> DataFrame:
    """``(key.., term, tf)``: how often a term occurs in a document."""
    return docs.select(*key, F.inline(token_counts("text")))


def smoothed_idf(df: Column, n_docs: int) -> Column:
    """ln((1 + n) / (1 + df)) + 1."""
    return F.log(F.lit(1.0 + n_docs) / (1.0 + df)) + 1.0


def bm25_idf(df: Column, n_docs: int) -> Column:
    """ln((n - df + 0.5) / (df + 0.5)); negative for terms in more than half of the documents."""
    return F.log((F.lit(n_docs + 0.5) - df) / (df + 0.5))


def _spread(docs: DataFrame, *columns: str) -> DataFrame:
    """Texts by key over all shuffle partitions. The number is fixed, as a text is small next to the
    work of counting its terms: adaptive execution would judge by bytes and merge the partitions."""
    return docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def raw_weights(docs: DataFrame, terms: DataFrame, n_docs: int, *key: str) -> DataFrame:
    """``(key.., term, df, raw)``: term count times smoothed IDF.

    No term is out of vocabulary: one unseen in training has df 0. Joined by term; the term table
    is broadcast only if its written size is below the session's threshold.
    """
    known = term_counts(docs, *key).join(terms, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    return known.select(*key, "term", "df", (F.col("tf") * smoothed_idf(F.col("df"), n_docs)).alias("raw"))


def tfidf_weights(
    docs: DataFrame, terms: DataFrame, n_docs: int, *key: str, together: Sequence[str] = ()
) -> DataFrame:
    """``(key.., term, df, weight)``: TF-IDF scaled to length one per document.

    Texts are moved once, by key (or by ``together``, a part of it that bounds a group). Norms are
    then taken in place, and the far more numerous terms do not move for them.
    """
    raw = raw_weights(_spread(docs, *(together or key)), terms, n_docs, *key)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*key)))
    return raw.select(*key, "term", "df", (F.col("raw") / norm).alias("weight"))


def average_length(examples: DataFrame, terms: DataFrame, n_docs: int) -> float:
    """Mean over all documents of the sum of their TF-IDF weights; documents without terms count.

    Equal texts have equal weights, so each distinct text is weighed once. A text's sum is the sum of
    its raw weights over their norm, one aggregate row per text.
    """
    texts = documents(examples).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = _spread(texts.select("text", F.md5("text").alias("doc"), "copies"), "doc")
    lengths = (
        raw_weights(keyed, terms, n_docs, "doc", "copies")
        .groupBy("doc", "copies")
        .agg((F.sum("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")))).alias("length"))
    )
    total = lengths.agg(F.sum(F.col("copies") * F.col("length"))).first()[0]
    return (total or 0.0) / n_docs


@dataclass(frozen=True)
class KeywordModel:
    """Fitted document frequencies, and what turns them into weights."""

    terms: DataFrame
    n_docs: int
    n_terms: int

    def weights(self, docs: DataFrame, *key: str, together: Sequence[str] = ()) -> DataFrame:
        """``(key.., term, weight)`` for documents ``(key.., text)``."""
        terms = batch_terms(self.terms, self.n_terms, docs)
        weighted = tfidf_weights(docs, terms, self.n_docs, *key, together=together)
        return weighted.select(*key, "term", "weight")

    def rank_responses(
        self, batches: DataFrame, n_candidates: int | None = None, block: int = BLOCK
    ) -> DataFrame:
        """Rank the N responses of each batch for each of its contexts; blocks of them where N is large."""
        whole = n_candidates is None or n_candidates <= block
        together = batches_together(n_candidates if whole else block)
        sides = batches.select(
            pack_of(together), "batch_id", "ctx_pos", "true_pos",
            F.inline(
                F.array(
                    F.struct(F.lit(True).alias("is_context"), F.col("context").alias("text")),
                    F.struct(F.lit(False).alias("is_context"), F.col("response").alias("text")),
                )
            ),
        )
        weights = self.weights(sides, "pack", "batch_id", "is_context", "ctx_pos", "true_pos", together=["pack"])
        weights = weights.withColumn("term", F.xxhash64("term"))  # a number is cheaper to hand over
        if not whole:
            return self._rank_in_blocks(batches, weights, n_candidates, block, together)

        def rank(places: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
            if together == 1:
                return rank_scores(places, sparse_scores(len(places), pieces), "batch")
            names, number = np.unique(places["batch"].to_numpy(), return_inverse=True)
            group = np.searchsorted(names, pieces["batch_id"].to_numpy())
            side = pieces["is_context"].to_numpy().astype(bool)
            listed = pieces.assign(group=group, pos=np.where(side, group * n_candidates, 0) + pieces["pos"])
            scores = grouped_scores((len(names) * n_candidates, n_candidates), listed[side], listed[~side])
            # a batch of fewer than n_candidates
            scores[np.arange(n_candidates) >= np.repeat(np.bincount(number), n_candidates)[:, None]] = -np.inf
            return rank_scores(places, scores, "batch", number * n_candidates + places["ctx_pos"].to_numpy())

        # new names keep the two sides of the cogroup apart
        places = batches.select(pack_of(together).alias("places"), F.col("batch_id").alias("batch"), "ctx_pos", "true_pos")
        pos = F.when(F.col("is_context"), F.col("ctx_pos")).otherwise(F.col("true_pos")).alias("pos")
        pieces = weights.select("pack", "batch_id", "is_context", pos, "term", "weight")
        return places.groupBy("places").cogroup(pieces.groupBy("pack")).applyInPandas(rank, RANKED)

    @staticmethod
    def _rank_in_blocks(batches: DataFrame, weights: DataFrame, n_candidates: int, block: int, together: int) -> DataFrame:
        """One row per example with the weights of both its texts, dealt to pairs of blocks."""
        keys = ["batch_id", "ctx_pos", "true_pos"]
        kinds = {f"{side}_{part}s": (side == "context", part, kind)
                 for side in ("context", "response") for part, kind in (("term", "long"), ("weight", "double"))}
        empty = {c: F.array().cast(f"array<{kind}>") for c, (_, _, kind) in kinds.items()}
        listed = weights.groupBy("pack", *keys).agg(
            *[F.collect_list(F.when(F.col("is_context") == side, F.col(part))).alias(c) for c, (side, part, _) in kinds.items()]
        )
        examples = batches.select(*keys).join(listed.drop("pack"), keys, "left")
        flat = examples.select(*keys, *[F.coalesce(c, empty[c]).alias(c) for c in kinds])
        # a candidate's context is of no use
        dealt = in_blocks(flat, n_candidates, block).withColumns(
            {c: F.when(F.col("is_context"), F.col(c)).otherwise(empty[c]) for c, (side, _, _) in kinds.items() if side}
        )

        def entries(rows: pd.DataFrame, side: str, is_context: bool) -> pd.DataFrame:
            """Terms and weights of one side, by the row's place."""
            counts = rows[f"{side}_terms"].map(len).to_numpy()
            return pd.DataFrame(
                {
                    "is_context": is_context,
                    "pos": np.repeat(np.arange(len(rows)), counts),
                    "term": np.concatenate([*rows[f"{side}_terms"], np.empty(0, np.int64)]).astype(np.int64),
                    "weight": np.concatenate([*rows[f"{side}_weights"], np.empty(0)]),
                }
            )

        def rank_block(rows: pd.DataFrame) -> pd.DataFrame:
            mine, others = rows[rows["is_context"]], rows[~rows["is_context"]]
            contexts = entries(mine, "context", True)
            both = contexts.merge(entries(mine, "response", False), on=["pos", "term"])
            own = np.bincount(both["pos"], both["weight_x"] * both["weight_y"], len(mine))
            candidates = entries(others, "response", False)
            if together == 1:
                scores = sparse_scores((len(mine), len(others)), pd.concat([contexts, candidates]))
                return partial_ranks(mine, others["true_pos"].to_numpy(), scores, own)
            # candidates by place in the block, which is the same for all batches
            first = int(rows["cand_block"].iloc[0]) * block
            batch, place = others["batch_id"].to_numpy(), others["true_pos"].to_numpy() - first
            names = np.unique(rows["batch_id"].to_numpy())
            there = np.zeros((len(names), block), bool)
            there[np.searchsorted(names, batch), place] = True
            here = there[np.searchsorted(names, mine["batch_id"].to_numpy())]
            scores = grouped_scores(
                (len(mine), block),
                contexts.assign(group=mine["batch_id"].to_numpy()[contexts["pos"]]),
                candidates.assign(group=batch[candidates["pos"]], pos=place[candidates["pos"]]),
            )
            scores[~here] = -np.inf
            met = here.any(axis=1)
            return partial_ranks(mine[met], first + np.arange(block), scores[met], own[met])

        return merge_blocks(dealt, rank_block, together)


@dataclass(frozen=True)
class Bm25Model(KeywordModel):
    """BM25 over TF-IDF weights; a document's length is the sum of its weights."""

    average_length: float
    k1: float
    b: float

    def weights(self, docs: DataFrame, *key: str, together: Sequence[str] = ()) -> DataFrame:
        terms = batch_terms(self.terms, self.n_terms, docs)
        weighted = tfidf_weights(docs, terms, self.n_docs, *key, together=together)
        length = F.sum("weight").over(Window.partitionBy(*key))
        damping = self.k1 * (1.0 - self.b + self.b * length / self.average_length)
        saturated = F.col("weight") * (self.k1 + 1.0) / (F.col("weight") + damping)
        return weighted.select(
            *key, "term", (saturated * bm25_idf(F.col("df"), self.n_docs)).alias("weight")
        )


class Terms(NamedTuple):
    """Terms with the number of documents that hold them, and how many documents and terms there are."""

    table: DataFrame
    n_docs: int
    n_terms: int


def fit_terms(examples: DataFrame) -> Terms:
    """The term table, the number of documents and that of terms, from one pass.

    Every document also holds the empty term, whose frequency is the number of documents: read from
    the written table, so a task that runs again counts nothing twice.
    """
    held = F.coalesce(F.array_distinct(tokens("text")), F.array().cast("array<string>"))
    every = documents(examples).select(F.explode(F.array_append(held, F.lit(""))).alias("term"))
    counts, n = materialise_counting(every.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")
    whole = counts.where("term = ''").first()
    return Terms(counts.where("term <> ''"), whole["df"] if whole else 0, max(0, n - 1))


def batch_terms(terms: DataFrame, n_terms: int, docs: DataFrame) -> DataFrame:
    """The term table for a join with ``docs``: broadcast if it is small, else cut to the terms of the
    documents first and broadcast if that is small. Only beyond both are terms joined by a shuffle."""
    if n_terms <= BROADCAST_ROWS:
        return broadcast_if_small(terms, n_terms)
    wanted = docs.select(F.explode(F.array_distinct(tokens("text"))).alias("term")).distinct()
    cut, n_terms = materialise_counting(terms.join(wanted, "term", "left_semi"), "batch-terms")
    return broadcast_if_small(cut, n_terms)


class TfIdf:
    """Cosine of TF-IDF vectors."""

    def fit(self, examples: DataFrame, terms: Terms | None = None) -> KeywordModel:
        """``terms`` are those of the examples, where they have been counted already."""
        return KeywordModel(*(terms or fit_terms(examples)))


class Bm25:
    """Dot product of BM25 vectors."""

    def __init__(self, k1: float = 2.0, b: float = 0.75):
        self.k1, self.b = k1, b

    def fit(self, examples: DataFrame, terms: Terms | None = None) -> Bm25Model:
        """``terms`` are those of the examples, where they have been counted already."""
        terms, n_docs, n_terms = terms or fit_terms(examples)
        # every term is one of the examples, so there is nothing to cut
        shared = broadcast_if_small(terms, n_terms)
        return Bm25Model(terms, n_docs, n_terms, average_length(examples, shared, n_docs), self.k1, self.b)
