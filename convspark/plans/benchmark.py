"""Evaluate ranking methods on example sets."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import cache, partial, reduce
from typing import NamedTuple, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convspark.operators.evaluate import accuracy, eval_batches, load_examples
from convspark.operators.keyword import Bm25, Terms, TfIdf, fit_terms
from convspark.operators.mapping import VectorMapping
from convspark.operators.ordering import ordered_index
from convspark.operators.vector import PRECOMPUTED, Encoder, LookupEncoder, VectorSimilarity, encode_once
from convspark.params import EvalOptions
from convspark.workspace import materialise_counting

_log = logging.getLogger(__name__)


class Model(Protocol):
    def rank_responses(self, batches: DataFrame, n_candidates: int | None = None) -> DataFrame: ...


class Ranker(Protocol):
    def fit(self, examples: DataFrame) -> Model: ...


@dataclass(frozen=True)
class VectorMethod:
    """A ranking method over an encoder; called, it gives a ranker that encodes for itself.

    A sweep encodes each data set once per encoder, for all methods over it, and hands the method vectors.
    """

    encoder: Encoder | LookupEncoder
    make: Callable[[Encoder | LookupEncoder], Ranker]

    def __call__(self) -> Ranker:
        return self.make(self.encoder)


def methods(encoders: Mapping[str, Encoder | LookupEncoder] | None = None) -> dict[str, Callable[[], Ranker]]:
    """Ranking methods by name: the keyword ones, and ``X_SIM`` and ``X_MAP`` per encoder X."""
    registry: dict[str, Callable[[], Ranker]] = {"TF_IDF": TfIdf, "BM25": Bm25}
    for name, encoder in (encoders or {}).items():
        registry[f"{name}_SIM"] = VectorMethod(encoder, VectorSimilarity)
        registry[f"{name}_MAP"] = VectorMethod(encoder, VectorMapping)
    return registry


class _Side(NamedTuple):
    rows: DataFrame
    size: int


def _load(examples: DataFrame, wanted: int | None, label: str, seed: int, deduplicate: bool = False) -> _Side:
    """Sample a side once, into a table; the order is random, so a prefix is a smaller sample."""
    rows, size = materialise_counting(load_examples(examples, wanted, seed, deduplicate), label)
    if wanted is not None and size < wanted:
        _log.warning("%d %s examples were requested, but there are only %d", wanted, label, size)
    return _Side(rows, size)


def _encoded(encoder: Encoder | LookupEncoder, *sides: _Side) -> tuple[_Side, ...]:
    """The sides with vectors for texts; examples that the encoder drops leave no gap in the numbering."""
    vectors = encode_once(encoder, *[side.rows for side in sides])
    found = []
    for side, rows in zip(sides, vectors, strict=True):
        rows, size = materialise_counting(rows, "encoded")
        if size < side.size:
            rows = ordered_index(rows.withColumnRenamed("ordinal", "before"), "before").drop("before")
        found.append(_Side(rows, size))
    return tuple(found)


def _test_rows(options: EvalOptions) -> int | None:
    return None if options.eval_num_batches is None else options.n_candidates * options.eval_num_batches


def _evaluated(
    ranker: Ranker, train: _Side, test: _Side, n_candidates: int, seed: int, terms: Callable[[], Terms] | None = None
) -> DataFrame:
    examples = train.rows.drop("ordinal")
    by_terms = terms is not None and isinstance(ranker, (TfIdf, Bm25))
    model = ranker.fit(examples, terms()) if by_terms else ranker.fit(examples)
    ranked = model.rank_responses(eval_batches(test.rows, n_candidates, seed), n_candidates)
    return accuracy(ranked).select(
        F.lit(train.size).cast("long").alias("train_size"),
        F.lit(test.size).cast("long").alias("test_size"),
        F.lit(n_candidates).cast("long").alias("recall_k"),
        "accuracy",
    )


def evaluate(
    ranker: Ranker, train: DataFrame, test: DataFrame, options: EvalOptions = EvalOptions(), seed: int = 0
) -> DataFrame:
    """Fit on ``train``, rank batches of ``test``: one row with sizes and accuracy."""
    fitted_on = _load(train, options.train_size, "train", seed)
    evaluated_on = _load(test, _test_rows(options), "test", seed, options.deduplicate_eval)
    return _evaluated(ranker, fitted_on, evaluated_on, options.n_candidates, seed)


def sweep(
    datasets: Mapping[str, tuple[DataFrame, DataFrame]],
    rankers: Mapping[str, Callable[[], Ranker]],
    options: EvalOptions = EvalOptions(),
    batches: Mapping[str, int] | None = None,
    seed: int = 0,
) -> DataFrame:
    """One result row per data set and method. Each set is sampled once, for all methods.

    Methods that share an encoder also share its vectors: every distinct text of a data set is encoded once
    per encoder. Keyword methods share the terms, counted once per data set. ``batches`` gives a slow method a number of batches of its own: it ranks the first ones of
    the same random order.
    """
    rows = []
    for dataset, (train, test) in datasets.items():
        fitted_on = _load(train, options.train_size, "train", seed)
        evaluated_on = _load(test, _test_rows(options), "test", seed, options.deduplicate_eval)
        shared: dict[int, tuple[_Side, _Side]] = {}
        terms = cache(partial(fit_terms, fitted_on.rows.drop("ordinal")))
        for method, ranker in rankers.items():
            learned_on, used = fitted_on, evaluated_on
            if isinstance(ranker, VectorMethod):
                key = id(ranker.encoder)
                if key not in shared:
                    shared[key] = _encoded(ranker.encoder, fitted_on, evaluated_on)
                (learned_on, used), ranker = shared[key], partial(ranker.make, PRECOMPUTED)
            if method in (batches or {}):
                limit = options.n_candidates * batches[method]
                used = _Side(used.rows.where(F.col("ordinal") < limit), min(used.size, limit))
            rows.append(
                _evaluated(ranker(), learned_on, used, options.n_candidates, seed, terms).select(
                    F.lit(method).alias("method"),
                    F.lit(f"{dataset}-train").alias("train"),
                    F.lit(f"{dataset}-test").alias("test"),
                    "train_size",
                    "test_size",
                    "recall_k",
                    "accuracy",
                )
            )
    return reduce(DataFrame.unionByName, rows)
