"""Vector rankers: encoders as Column functions, similarity, and a fixed linear map."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convspark.operators.scoring import (
    BLOCK,
    RANKED,
    dense_scores,
    in_blocks,
    merge_blocks,
    partial_ranks,
    rank_scores,
    stack,
    unit_rows,
)
from convspark.workspace import materialise

ENCODING_BATCH_SIZE = 100


@dataclass(frozen=True)
class Encoder:
    """Maps text columns to ``array<float>`` columns; responses use the context side by default."""

    encode_context: Callable[[Column], Column]
    encode_response: Callable[[Column], Column] | None = None

    def encode(self, examples: DataFrame) -> DataFrame:
        """Replace ``context`` and ``response`` by their vectors."""
        response = self.encode_response or self.encode_context
        return examples.withColumns(
            {"context": self.encode_context(F.col("context")), "response": response(F.col("response"))}
        )

    @property
    def two_sided(self) -> bool:
        """Whether a text has one vector as a context and another one as a response."""
        return self.encode_response is not None

    def vectors(self, texts: DataFrame) -> DataFrame:
        """(``side``, ``text``, ``vector``) of distinct texts (``side``, ``text``)."""
        if self.encode_response is None:
            return texts.withColumn("vector", self.encode_context(F.col("text")))
        sides = (("context", self.encode_context), ("response", self.encode_response))
        parts = [texts.where(F.col("side") == side).withColumn("vector", f(F.col("text"))) for side, f in sides]
        return parts[0].unionByName(parts[1])


#: For examples whose ``context`` and ``response`` are vectors already.
PRECOMPUTED = Encoder(lambda vectors: vectors)

#: What :class:`LookupEncoder` does with a text that has no vector.
MISSES = ("error", "zero", "drop")


@dataclass(frozen=True)
class LookupEncoder:
    """An encoder that is a table of embeddings by text, joined instead of computed.

    ``missing`` says what becomes of a text without a vector: an ``error`` (the default), the ``zero`` vector,
    or ``drop`` for examples that hold such a text. A null vector is none, and a null text has none. Of
    several vectors of a text the smallest counts.
    """

    embeddings: DataFrame
    text_column: str = "text"
    vector_column: str = "embedding"
    missing: str = "error"

    two_sided = False

    def __post_init__(self) -> None:
        if self.missing not in MISSES:
            raise ValueError(f"missing must be one of {MISSES}, got {self.missing!r}")

    def vectors(self, texts: DataFrame) -> DataFrame:
        """(``side``, ``text``, ``vector``) of distinct texts (``side``, ``text``); the table moves by hash, once."""
        known = self.embeddings.select(
            F.col(f"`{self.text_column}`").alias("text"), F.col(f"`{self.vector_column}`").alias("vector")
        ).where("text IS NOT NULL AND vector IS NOT NULL")
        keyed = [df.withColumn("_hash", F.xxhash64("text")) for df in (texts, known)]
        found = keyed[0].join(keyed[1], ["_hash", "text"]).groupBy("side", "text").agg(F.min("vector").alias("vector"))
        return found

    def fill(self, encoded: DataFrame) -> DataFrame:
        """Apply the policy to examples whose vectors are null where there is none."""
        sides = ("context", "response")
        if self.missing == "drop":
            return encoded.dropna(subset=sides)
        if self.missing == "error":
            error = F.raise_error(F.lit("a text has no vector in the table of embeddings"))
            return encoded.withColumns({c: F.coalesce(F.col(c), error.cast(encoded.schema[c].dataType)) for c in sides})
        first = self.embeddings.select(F.size(f"`{self.vector_column}`")).where(F.col(f"`{self.vector_column}`").isNotNull())
        size = first.first()
        zero = F.array_repeat(F.lit(0.0), 0 if size is None else size[0])
        return encoded.withColumns({c: F.coalesce(F.col(c), zero.cast(encoded.schema[c].dataType)) for c in sides})

    def encode(self, examples: DataFrame) -> DataFrame:
        """Replace ``context`` and ``response`` by their vectors."""
        return encode_once(self, examples)[0]


def encode_once(encoder: Encoder | LookupEncoder, *frames: DataFrame) -> list[DataFrame]:
    """Each table of examples with vectors for texts, every distinct text of all of them being encoded once.

    The distinct texts are collected per task before the shuffle, encoded, and kept as a table, the dictionary; the
    examples are joined with it, side by side, by hash and text. A text that many examples share is a key
    with one row in the dictionary, which is broadcast if it is small and which adaptive execution splits the
    examples for if it is not. A null text is encoded as the empty one, but not looked up.
    """
    looked_up = isinstance(encoder, LookupEncoder)

    def text(c: str) -> Column:
        return F.col(c) if looked_up else F.coalesce(F.col(c), F.lit(""))

    def side(c: str) -> Column:
        return F.lit(c if encoder.two_sided else "both")

    texts = reduce(
        DataFrame.unionByName,
        [
            df.select(F.inline(F.array(*[F.struct(side(c).alias("side"), text(c).alias("text")) for c in ("context", "response")])))
            for df in frames
        ],
    )
    # spread over all tasks: to encode is the work here, and the texts may be few and small
    tasks = max(frames[0].sparkSession.sparkContext.defaultParallelism, _shuffle_partitions(frames[0]))
    distinct = texts.where("text IS NOT NULL").distinct().repartition(tasks, F.xxhash64("side", "text"))
    dictionary = materialise(encoder.vectors(distinct), "vectors").withColumn("_hash", F.xxhash64("side", "text"))
    encoded = []
    for df in frames:
        for c in ("context", "response"):
            vectors = dictionary.select(
                "_hash", F.col("side").alias("_side"), F.col("text").alias("_text"), F.col("vector").alias("_vector")
            )
            keyed = df.withColumns({"_hash": F.xxhash64(side(c), text(c)), "_side": side(c), "_text": text(c)})
            df = keyed.join(vectors, ["_hash", "_side", "_text"], "left").select(
                *[F.col("_vector").alias(n) if n == c else F.col(f"`{n}`") for n in df.columns]
            )
        encoded.append(encoder.fill(df) if looked_up else df)
    return encoded


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def model_encoder(
    encode: Callable[[list[str]], np.ndarray],
    encode_response: Callable[[list[str]], np.ndarray] | None = None,
    batch_size: int = ENCODING_BATCH_SIZE,
) -> Encoder:
    """An encoder from functions ``texts -> (len(texts), d)`` matrix, called on Arrow batches."""

    def as_column(function: Callable[[list[str]], np.ndarray]) -> Callable[[Column], Column]:
        @F.pandas_udf("array<float>")
        def encoded(texts: pd.Series) -> pd.Series:
            rows: list[np.ndarray] = []
            for start in range(0, len(texts), batch_size):
                rows.extend(np.asarray(function(texts.iloc[start : start + batch_size].tolist()), dtype="float32"))
            return pd.Series(rows, index=texts.index, dtype="object")

        return encoded

    return Encoder(as_column(encode), as_column(encode_response) if encode_response else None)


#: A function of context and response matrices that gives both in the form whose dot products are the scores.
Sides = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def rank_vectors(
    batches: DataFrame, encoder: Encoder | LookupEncoder, sides: Sides, n_candidates: int | None, block: int
) -> DataFrame:
    """Rank each batch by the dot products of what ``sides`` makes of its contexts and responses.

    A batch is one task's matrix product, unless ``n_candidates`` is larger than a block: then its contexts
    and candidates are dealt into blocks, each pair of blocks is a task of its own, and what is best
    and ahead in each is merged.
    """
    encoded = encoder.encode(batches.select("batch_id", "ctx_pos", "true_pos", "context", "response"))
    blocks = in_blocks(encoded, n_candidates, block)
    if blocks is None:

        def rank(batch: pd.DataFrame) -> pd.DataFrame:
            contexts, responses = sides(
                stack(batch.sort_values("ctx_pos")["context"]), stack(batch.sort_values("true_pos")["response"])
            )
            return rank_scores(batch, dense_scores(contexts, responses))

        return encoded.groupBy("batch_id").applyInPandas(rank, RANKED)

    def rank_block(rows: pd.DataFrame) -> pd.DataFrame:
        mine, others = rows[rows["is_context"]], rows[~rows["is_context"]]
        contexts, own = sides(stack(mine["context"]), stack(mine["response"]))
        _, candidates = sides(stack(others["context"]), stack(others["response"]))
        scores = dense_scores(contexts, candidates)
        return partial_ranks(mine, others["true_pos"].to_numpy(), scores, (contexts * own).sum(axis=1))

    return merge_blocks(blocks, rank_block)


@dataclass(frozen=True)
class VectorSimilarity:
    """Context vector times response vector of length one. ``normalise=False`` gives plain dot products."""

    encoder: Encoder | LookupEncoder
    normalise: bool = True

    def fit(self, examples: DataFrame) -> VectorSimilarity:
        return self

    def rank_responses(
        self, batches: DataFrame, n_candidates: int | None = None, block: int = BLOCK
    ) -> DataFrame:
        normalise = self.normalise  # the encoder itself must not travel with the function

        def sides(contexts: np.ndarray, responses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return contexts, unit_rows(responses) if normalise else responses

        return rank_vectors(batches, self.encoder, sides, n_candidates, block)


@dataclass(frozen=True)
class MappingModel:
    """A fitted map: both sides scaled to length one, the response side times ``weights`` plus
    ``residual`` times itself."""

    encoder: Encoder | LookupEncoder
    weights: np.ndarray
    residual: float

    def fit(self, examples: DataFrame) -> MappingModel:
        """The map as it is: a method of its own in a sweep."""
        return self

    def rank_responses(
        self, batches: DataFrame, n_candidates: int | None = None, block: int = BLOCK
    ) -> DataFrame:
        weights, residual = self.weights, self.residual

        def sides(contexts: np.ndarray, responses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            unit = unit_rows(responses)
            return unit_rows(contexts), unit @ weights + residual * unit

        return rank_vectors(batches, self.encoder, sides, n_candidates, block)
