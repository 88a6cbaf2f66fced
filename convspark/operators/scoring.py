"""Scoring all candidates of a batch: one matrix product per batch of N, inside a task.

A batch holds exactly N contexts and N responses, so a group is bounded by construction, and no
(context, response) pair ever becomes a row: only one row per context leaves the task. Small batches are
ranked many to a group, as a call has a cost of its own. Where N is larger than :data:`BLOCK`, the product is cut
into blocks of contexts times blocks of candidates, each a group of its own; one row per context and block of
candidates is merged.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Contexts, and candidates, of one matrix product at most: 32 MB of scores.
BLOCK = 2048
#: Contexts that one call ranks together, where batches or blocks are smaller.
TOGETHER = 1024
#: Pairs of equal terms that are multiplied at once.
_PAIRS = 1_000_000

PARTIAL = "batch_id long, ctx_pos int, true_pos int, best_pos int, best double, ahead long"
RANKED = "batch_id long, ctx_pos int, true_pos int, predicted_pos int, true_rank int, score double"

# Scores are compared after rounding to this many digits, so that sums taken in another order tie
# in the same way; ties go to the first candidate.
SCORE_DIGITS = 9

_TERM_BLOCK = 4096


def batches_together(size: int | None) -> int:
    """How many batches, or blocks, of ``size`` contexts are one group; one if the size is not known."""
    return 1 if size is None else max(1, TOGETHER // max(1, size))


def pack_of(together: int) -> Column:
    """The number of the group of ``together`` batches that a batch is in."""
    return F.floor(F.col("batch_id") / together).alias("pack")


def rank_scores(
    places: pd.DataFrame, scores: np.ndarray, batch: str = "batch_id", rows: np.ndarray | None = None
) -> pd.DataFrame:
    """Best candidate and rank of the true one for every context of one batch, or of several.

    ``scores`` is contexts by candidates; ``places`` has the batch number, ctx_pos and true_pos. ``rows`` tells
    the row of ``scores`` of each place where it is not its ctx_pos.
    """
    scores = np.round(scores, SCORE_DIGITS) + 0.0
    ctx, true = places["ctx_pos"].to_numpy(), places["true_pos"].to_numpy()
    mine = scores[ctx if rows is None else rows]
    own = mine[np.arange(len(ctx)), true][:, None]
    earlier = np.arange(scores.shape[1])[None, :] < true[:, None]
    ahead = (mine > own) | ((mine == own) & earlier)
    best = mine.argmax(axis=1)
    return pd.DataFrame(
        {
            "batch_id": places[batch].to_numpy(),
            "ctx_pos": ctx,
            "true_pos": true,
            "predicted_pos": best.astype("int32"),
            "true_rank": (ahead.sum(axis=1) + 1).astype("int32"),
            "score": mine[np.arange(len(ctx)), best],
        }
    )


def in_blocks(batches: DataFrame, n_candidates: int | None, block: int = BLOCK) -> DataFrame | None:
    """Rows of batches dealt to all pairs of blocks they belong to, or None if a batch is one block.

    Each row goes as a context (``is_context``) to all blocks of candidates, and as a candidate to all
    blocks of contexts: columns ``ctx_block`` and ``cand_block``.
    """
    if n_candidates is None or n_candidates <= block:
        return None
    every = F.sequence(F.lit(0), F.lit((n_candidates - 1) // block))
    own = {c: F.floor(F.col(c) / block).cast("int") for c in ("ctx_pos", "true_pos")}
    contexts = batches.select(
        "*", F.lit(True).alias("is_context"), own["ctx_pos"].alias("ctx_block"), F.explode(every).alias("cand_block")
    )
    candidates = batches.select(
        "*", F.lit(False).alias("is_context"), F.explode(every).alias("ctx_block"), own["true_pos"].alias("cand_block")
    )
    return contexts.unionByName(candidates)


def partial_ranks(contexts: pd.DataFrame, positions: np.ndarray, scores: np.ndarray, own: np.ndarray) -> pd.DataFrame:
    """Best candidate of one block for each context, and how many of the block come before the true one.

    ``contexts`` has batch_id, ctx_pos and true_pos, ``positions`` are those of the block's candidates, ``own``
    the scores of the true responses. A candidate that is none has a score of minus infinity.
    """
    order = np.argsort(positions, kind="stable")
    positions, scores = positions[order], np.round(scores[:, order], SCORE_DIGITS) + 0.0
    own = (np.round(own, SCORE_DIGITS) + 0.0)[:, None]
    true = contexts["true_pos"].to_numpy()[:, None]
    ahead = ((scores > own) | ((scores == own) & (positions < true))) & (positions != true)
    best = scores.argmax(axis=1)
    return pd.DataFrame(
        {
            "batch_id": contexts["batch_id"].to_numpy(),
            "ctx_pos": contexts["ctx_pos"].to_numpy(),
            "true_pos": contexts["true_pos"].to_numpy(),
            "best_pos": positions[best].astype("int32"),
            "best": scores[np.arange(len(scores)), best],
            "ahead": ahead.sum(axis=1),
        }
    )


def merge_blocks(
    blocks: DataFrame, rank_block: Callable[[pd.DataFrame], pd.DataFrame], together: int = 1
) -> DataFrame:
    """Ranks over all candidates from those of each block; the first of equally good candidates is best.

    ``rank_block`` gets the same block of ``together`` batches.
    """
    partial = blocks.groupBy(pack_of(together), "ctx_block", "cand_block").applyInPandas(rank_block, PARTIAL)
    merged = partial.groupBy("batch_id", "ctx_pos", "true_pos").agg(
        F.min(F.struct((-F.col("best")).alias("minus"), "best_pos")).alias("_best"), F.sum("ahead").alias("_ahead")
    )
    return merged.select(
        "batch_id",
        "ctx_pos",
        "true_pos",
        F.col("_best.best_pos").alias("predicted_pos"),
        (F.col("_ahead") + 1).cast("int").alias("true_rank"),
        (-F.col("_best.minus") + 0.0).alias("score"),
    )


def sparse_scores(size: int | tuple[int, int], weights: pd.DataFrame) -> np.ndarray:
    """Dot products of sparse context and response rows ``(is_context, pos, term, weight)``.

    ``size`` is the number of contexts and of responses, or both. Terms are taken in blocks, so memory stays at
    ``size * block`` whatever the vocabulary.
    """
    rows, columns = size if isinstance(size, tuple) else (size, size)
    scores = np.zeros((rows, columns))
    if weights.empty:
        return scores
    terms, column = np.unique(weights["term"].to_numpy(), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column = column[order]
    side = weights["is_context"].to_numpy()[order].astype(bool)
    pos = weights["pos"].to_numpy()[order]
    weight = weights["weight"].to_numpy()[order]
    step = min(_TERM_BLOCK, max(256, _TERM_BLOCK * 1024 // max(rows, columns, 1)))
    for start in range(0, len(terms), step):
        low, high = np.searchsorted(column, [start, start + step])
        left, right = np.zeros((rows, step)), np.zeros((columns, step))
        for matrix, chosen in ((left, side[low:high]), (right, ~side[low:high])):
            matrix[pos[low:high][chosen], column[low:high][chosen] - start] = weight[low:high][chosen]
        scores += left @ right.T
    return scores


def grouped_scores(shape: tuple[int, int], left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Dot products of sparse rows ``(group, pos, term, weight)``, within groups only.

    A cell is that of a left and a right ``pos``; what is never together in a group scores 0. Made for many small
    groups: equal terms of a group are paired, a bounded number of pairs at once.
    """
    rows, columns = shape
    scores = np.zeros(rows * columns)
    group, term = (np.concatenate([left[c].to_numpy(), right[c].to_numpy()]) for c in ("group", "term"))
    if not len(left) or not len(right):
        return scores.reshape(shape)
    order = np.lexsort((term, group))
    new = (np.diff(group[order]) != 0) | (np.diff(term[order]) != 0)
    code = np.empty(len(order), np.int64)
    code[order] = np.concatenate([[0], np.cumsum(new)])
    mine, theirs = code[: len(left)], code[len(left) :]
    by = np.argsort(theirs, kind="stable")
    counts = np.bincount(theirs, minlength=code.max() + 1)
    first = np.cumsum(counts) - counts
    wide = counts[mine]
    ends = np.cumsum(wide)
    left_cell, right_cell = left["pos"].to_numpy().astype(np.int64) * columns, right["pos"].to_numpy()
    left_weight, right_weight = left["weight"].to_numpy(), right["weight"].to_numpy()
    start = 0
    while start < len(mine):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + _PAIRS, "right")))
        n = wide[start:stop]
        inside = np.arange(ends[stop - 1] - done) - np.repeat(ends[start:stop] - n - done, n)
        one = np.repeat(np.arange(start, stop), n)
        two = by[np.repeat(first[mine[start:stop]], n) + inside]
        scores += np.bincount(left_cell[one] + right_cell[two], left_weight[one] * right_weight[two], len(scores))
        start = stop
    return scores.reshape(shape)


def dense_scores(contexts: np.ndarray, responses: np.ndarray) -> np.ndarray:
    """Dot products of dense context and response rows."""
    return contexts @ responses.T


def stack(column: pd.Series) -> np.ndarray:
    """A column of equally long vectors as a matrix."""
    return np.stack(column.to_numpy()).astype("float64")


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
