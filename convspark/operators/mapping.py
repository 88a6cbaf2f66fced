"""Fitting the linear map of the response side, with a grid search, as data-parallel passes.

One Spark job per epoch for all settings still running: the batches lie in streams, one partition each; a
task goes through its stream with one Adagrad step per batch, for every setting, and the maps of all
streams are averaged on the cluster, weighted by their batches. The driver holds only what has the
size of the models.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convspark.operators.ordering import dense_index
from convspark.operators.scoring import stack, unit_rows
from convspark.operators.vector import Encoder, MappingModel
from convspark.workspace import materialise, materialise_counting

# Fixed values of the published training set-up.
LEARNING_RATES = (10.0, 3.0, 1.0, 0.3, 0.01)
REGULARIZERS = (0.0, 0.1, 0.01, 0.001)
TRAIN_BATCH_SIZE = 256
DEV_BATCH_SIZE = 100
DEV_SHARE = 0.2
LABEL_SMOOTHING = 0.2
MAX_EPOCHS = 100
PATIENCE = 9
_ADAGRAD_START = 0.1

#: Batches of a stream, so that a map moves well between two averages; and streams at most.
BATCHES_PER_STREAM = 32
MAX_STREAMS = 4096

# Sums travel in pieces of this many numbers, so that no group grows with the square of the dimension.
_PIECE = 16_384
_PARTIAL = "setting int, piece int, part int, total array<double>"
GRADIENT = "kind string, row int, col int, value double"


def batch_gradient(
    contexts: np.ndarray, responses: np.ndarray, weights: np.ndarray, residual: float
) -> tuple[np.ndarray, float, float]:
    """Gradient of the smoothed in-batch softmax loss by the map and the residual, and the loss."""
    n = len(contexts)
    scores = contexts @ (responses @ weights + residual * responses).T
    scores -= scores.max(axis=1, keepdims=True)
    log_share = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    target = np.full((n, n), LABEL_SMOOTHING / n)
    target[np.diag_indices(n)] += 1.0 - LABEL_SMOOTHING
    by_mapped = ((np.exp(log_share) - target) / n).T @ contexts
    return responses.T @ by_mapped, float((by_mapped * responses).sum()), float(-(target * log_share).sum() / n)


def dev_hits(contexts: np.ndarray, responses: np.ndarray, weights: np.ndarray, residual: float) -> int:
    """How many contexts rank their own response first within the batch."""
    scores = contexts @ (responses @ weights + residual * responses).T
    return int((scores.argmax(axis=1) == np.arange(len(contexts))).sum())


@dataclass
class _Map:
    """A map with its Adagrad state, as one run of numbers: weights, residual, and their summed squares."""

    numbers: np.ndarray

    @classmethod
    def start(cls, dim: int, seed: int) -> _Map:
        """An orthogonal map, residual one."""
        weights = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))[0]
        return cls(np.concatenate([weights.ravel(), [1.0], np.full(dim * dim + 1, _ADAGRAD_START)]))

    @property
    def _half(self) -> int:
        return len(self.numbers) // 2

    @property
    def weights(self) -> np.ndarray:
        dim = round((self._half - 1) ** 0.5)
        return self.numbers[: self._half - 1].reshape(dim, dim)

    @property
    def residual(self) -> float:
        return float(self.numbers[self._half - 1])

    def step(self, by_weights: np.ndarray, by_residual: float, learning_rate: float, regularizer: float) -> None:
        gradient = np.append((by_weights + regularizer * self.weights).ravel(), by_residual)
        self.numbers[self._half :] += gradient**2
        self.numbers[: self._half] -= learning_rate * gradient / np.sqrt(self.numbers[self._half :])


@dataclass
class _Setting:
    learning_rate: float
    regularizer: float
    map: _Map
    best_accuracy: float = -1.0
    best: tuple[np.ndarray, float] | None = None
    best_epoch: int = 0
    stale: int = 0
    loss: float | None = None

    def record(self, accuracy: float, epoch: int) -> None:
        if accuracy > self.best_accuracy:
            self.best_accuracy, self.best_epoch, self.stale = accuracy, epoch, 0
            self.best = (self.map.weights.copy(), self.map.residual)
        else:
            self.stale += 1


def _matrices(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """Whether a batch is of the dev share, and its contexts and responses, scaled to length one."""
    for frame in frames:
        for is_dev, contexts, responses in zip(frame["is_dev"], frame["contexts"], frame["responses"], strict=True):
            yield is_dev, *(unit_rows(stack(pd.Series(list(v)))) for v in (contexts, responses))


def _sum_over_tasks(
    batches: DataFrame, totals: Callable[[Iterator[pd.DataFrame]], dict[int, np.ndarray]]
) -> dict[int, np.ndarray]:
    """What every task has for each setting, added up on the cluster; the sums, of the models' size, come back."""
    # sums are added by groups of tasks first, so that no group grows with the number of tasks
    spread = max(1, int(batches.rdd.getNumPartitions() ** 0.5))

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() % spread
        for i, total in totals(frames).items():
            pieces = [total[at : at + _PIECE] for at in range(0, len(total), _PIECE)]
            yield pd.DataFrame({"setting": i, "piece": range(len(pieces)), "part": part, "total": pieces})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[[0]].reset_index(drop=True)
        first.at[0, "total"] = np.sum(np.stack(group["total"].to_numpy()), axis=0)
        return first

    partial = batches.mapInPandas(parts, _PARTIAL).groupBy("setting", "piece", "part").applyInPandas(add, _PARTIAL)
    summed = partial.groupBy("setting", "piece").applyInPandas(add, _PARTIAL).toPandas()
    return {
        int(i): np.concatenate(rows["total"].to_numpy()) for i, rows in summed.sort_values("piece").groupby("setting")
    }


def pack_batches(numbered: DataFrame, encoder: Encoder) -> tuple[DataFrame, int]:
    """Batches of examples with an ``ordinal``, encoded, and the number of those for training.

    One row per batch: ``is_dev``, ``batch``, ``contexts``, ``responses``. The first fifth of the examples,
    in batches of 100, is the dev share; the others are cut into batches of 256. Each text is encoded
    once: the batches are a table.
    """
    numbered, n = materialise_counting(numbered.select("ordinal", "context", "response"), "pairs")
    indexed = encoder.encode(numbered)
    n_dev = int(np.ceil(DEV_SHARE * n))
    is_dev = F.col("ordinal") < n_dev
    batch = F.when(is_dev, F.floor(F.col("ordinal") / DEV_BATCH_SIZE)).otherwise(
        F.floor((F.col("ordinal") - n_dev) / TRAIN_BATCH_SIZE)
    )
    packed = (
        indexed.groupBy(is_dev.alias("is_dev"), batch.alias("batch"))
        .agg(F.array_sort(F.collect_list(F.struct("ordinal", "context", "response"))).alias("pairs"))
        .select("is_dev", "batch", F.col("pairs.context").alias("contexts"), F.col("pairs.response").alias("responses"))
    )
    return materialise(packed, "batches"), -(-(n - n_dev) // TRAIN_BATCH_SIZE)


def mapping_gradient(batches: DataFrame, weights: np.ndarray, residual: float) -> DataFrame:
    """One pass over :func:`pack_batches` at a fixed map: mean gradient, mean loss, dev accuracy.

    Rows ``kind``, ``row``, ``col``, ``value``: ``weights`` for every number of the map, and one of
    ``residual``, ``loss`` and ``dev_accuracy``.
    """
    size = weights.size

    def totals(frames: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
        total = np.zeros(size + 5)
        for is_dev, contexts, responses in _matrices(frames):
            if is_dev:
                total[-2:] += dev_hits(contexts, responses, weights, residual), len(contexts)
            else:
                by_weights, by_residual, loss = batch_gradient(contexts, responses, weights, residual)
                total[:-5] += by_weights.ravel()
                total[-5:-2] += by_residual, loss, 1
        return {0: total}

    total = _sum_over_tasks(batches, totals).get(0, np.zeros(size + 5))
    n, dev_rows = max(total[-3], 1.0), max(total[-1], 1.0)
    rows = [("weights", k // len(weights), k % len(weights), float(x)) for k, x in enumerate(total[:-5] / n)]
    rows += [("residual", 0, 0, total[-5] / n), ("loss", 0, 0, total[-4] / n), ("dev_accuracy", 0, 0, total[-2] / dev_rows)]
    return batches.sparkSession.createDataFrame([(k, i, j, float(x)) for k, i, j, x in rows], GRADIENT)


@dataclass(frozen=True)
class MappingFit:
    """The winning map and one ``(learning_rate, regularizer, epoch, dev_accuracy)`` per setting."""

    model: MappingModel
    trials: list[tuple[float, float, int, float]]


class VectorMapping:
    """Learns ``weights`` and ``residual`` over a grid; the best dev accuracy wins.

    ``sample`` bounds the random examples that the map is fitted on; None takes all. ``streams`` is the number
    of step sequences that run side by side and are averaged after each epoch; 1 is plain stochastic
    descent. By default a stream has about :data:`BATCHES_PER_STREAM` batches, so that their number follows
    the data and not the cluster, and the fit is the same on any.
    """

    def __init__(
        self,
        encoder: Encoder,
        learning_rates: tuple[float, ...] = LEARNING_RATES,
        regularizers: tuple[float, ...] = REGULARIZERS,
        max_epochs: int = MAX_EPOCHS,
        seed: int = 0,
        sample: int | None = None,
        streams: int | None = None,
    ):
        self.encoder = encoder
        self.sample = sample
        self.grid = list(itertools.product(learning_rates, regularizers))
        self.max_epochs = max_epochs
        self.seed = seed
        self.streams = streams

    def _epoch(self, batches: DataFrame, running: dict[int, _Setting]) -> dict[int, tuple[float, _Map]]:
        """One step per batch in every stream, then the average of the streams, for each setting.

        The dev accuracy is that of the map with which the epoch began.
        """
        given = batches.sparkSession.sparkContext.broadcast(
            {i: (s.map.numbers, s.learning_rate, s.regularizer) for i, s in running.items()}
        )

        def totals(frames: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
            maps = {i: _Map(numbers.copy()) for i, (numbers, _, _) in given.value.items()}
            tails = {i: np.zeros(4) for i in maps}  # loss, batches, hits, dev rows
            for is_dev, contexts, responses in _matrices(frames):
                for i, (numbers, learning_rate, regularizer) in given.value.items():
                    if is_dev:
                        first = _Map(numbers)
                        tails[i][2:] += dev_hits(contexts, responses, first.weights, first.residual), len(contexts)
                    else:
                        now = maps[i]
                        by_weights, by_residual, loss = batch_gradient(contexts, responses, now.weights, now.residual)
                        now.step(by_weights, by_residual, learning_rate, regularizer)
                        tails[i][:2] += loss, 1
            return {i: np.concatenate([tails[i][1] * maps[i].numbers, tails[i]]) for i in maps}

        summed = _sum_over_tasks(batches, totals)
        given.unpersist()
        out = {}
        for i, total in summed.items():
            loss, n, hits, dev_rows = total[-4:]
            running[i].loss = float(loss / max(n, 1.0))
            out[i] = float(hits / max(dev_rows, 1.0)), _Map(total[:-4] / n) if n else running[i].map
        return out

    def search(self, examples: DataFrame) -> MappingFit:
        """Run the grid; a setting stops after ``PATIENCE`` epochs without a better dev accuracy."""
        numbered = dense_index(examples.select("context", "response"), self.seed, limit=self.sample)
        packed, n_train = pack_batches(numbered, self.encoder)
        first = packed.select(F.size(F.get("contexts", F.lit(0)))).first()
        if first is None:
            raise ValueError("no training examples")
        streams = self.streams or min(max(1, n_train // BATCHES_PER_STREAM), MAX_STREAMS)
        # a task that runs again takes the same steps: a stream is a partition, sorted
        batches = (
            packed.repartitionById(streams, (F.col("batch") % streams).cast("int"))
            .sortWithinPartitions("is_dev", "batch")
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        try:
            settings = [_Setting(lr, reg, _Map.start(first[0], self.seed)) for lr, reg in self.grid]
            for epoch in range(self.max_epochs + 1):
                running = {i: s for i, s in enumerate(settings) if s.stale < PATIENCE}
                if not running:
                    break
                for i, (accuracy, after) in self._epoch(batches, running).items():
                    if epoch:
                        running[i].record(accuracy, epoch)
                    running[i].map = after
        finally:
            batches.unpersist()
        best = max(settings, key=lambda s: s.best_accuracy)  # the first of equals
        model = MappingModel(self.encoder, *best.best)
        return MappingFit(model, [(s.learning_rate, s.regularizer, s.best_epoch, s.best_accuracy) for s in settings])

    def fit(self, examples: DataFrame) -> MappingModel:
        return self.search(examples).model
