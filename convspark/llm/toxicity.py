"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm.batches import map_rows, struct_of

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are features.
BEGINNINGS = (4, 5, 6)
#: Hashed weights that a worker remembers by word.
_REMEMBERED = 200_000


@dataclass(frozen=True)
class ToxicityOptions:
    """``max_positive`` and ``max_unlabelled`` bound the sample that the classifier is fitted on.

    ``prior`` is the share of toxic texts; None takes the share among labelled rows of the fold that
    may be learnt from. A feature takes part if at least ``min_texts`` and ``min_share`` of the
    confirmed texts have it, ``min_lift`` times the share of unlabelled texts that do.
    """

    bits: int = 20
    max_positive: int = 4000
    max_unlabelled: int = 16000
    prior: float | None = None
    min_texts: int = 3
    min_share: float = 0.01
    min_lift: float = 3.0
    steps: int = 300
    rate: float = 0.05
    l1: float = 1e-4
    seed: int = 5


@dataclass(frozen=True)
class ToxicityModel:
    """A linear classifier over the set of a text's hashed features."""

    bits: int
    weights: np.ndarray
    bias: float


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def word_features(word: str, bits: int) -> list[int]:
    """Hashes of a word and of its beginnings, so that other endings of a known word are known too."""
    mask = (1 << bits) - 1
    parts = [word, *(f"^{word[:k]}" for k in BEGINNINGS if k <= len(word))]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) & mask for p in parts]


def text_features(text: str, bits: int) -> list[int]:
    """Distinct features of a text's words, ascending."""
    return sorted({f for w in set(_WORD.findall(text.lower())) for f in word_features(w, bits)})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Sets:
    """Sets of features: all features one after another, and the set that each belongs to."""

    features: np.ndarray
    owner: np.ndarray
    n: int


def fit_classifier(
    positive: Sets, unlabelled: Sets, prior: float, n_features: int, options: ToxicityOptions
) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk estimate with logistic loss.

    With class prior p, the risk is p * R_P(+) + max(0, R_U(-) - p * R_P(-)): unlabelled texts stand
    for clean ones after the share that toxic ones among them would add is taken out. Where that
    difference is negative the model has begun to fit the toxic share of the unlabelled texts, and the
    step goes up on the difference instead. Adam steps over the whole sample, as the difference of two
    means is too noisy in small batches; an L1 shrinkage keeps features without a signal at nought.
    Weights are not negative: evidence adds up, and the many harmless words of a long text cannot talk
    it away. ``p`` must be in (0, 1).
    """
    pf, pp, n_p = positive.features, positive.owner, positive.n
    uf, up, n_u = unlabelled.features, unlabelled.owner, unlabelled.n
    weights, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, options.steps + 1):
        toxic = _sigmoid(np.bincount(pp, weights[pf], n_p) + bias)
        other = _sigmoid(np.bincount(up, weights[uf], n_u) + bias)
        clean = -np.log1p(-np.minimum(other, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(toxic, 1 - 1e-12)).mean()
        # derivatives by the score: of the loss as toxic s - 1, as clean s
        if clean >= 0:
            by_toxic, by_other = prior * (toxic - 1) / n_p - prior * toxic / n_p, other / n_u
        else:
            by_toxic, by_other = prior * toxic / n_p, -other / n_u
        gradient = np.bincount(pf, by_toxic[pp], n_features) + np.bincount(uf, by_other[up], n_features)
        gradient = np.append(gradient, by_toxic.sum() + by_other.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        scale = options.rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        move = scale * first / (1 - 0.9**step)
        weights = np.maximum(weights - move[:-1] - scale[:-1] * options.l1, 0)
        bias -= move[-1]
    return weights, bias


def _sampled(rows: DataFrame, n: int, limit: int, seed: int) -> DataFrame:
    """About ``limit`` of ``n`` rows, chosen by a hash of the id."""
    if n <= limit:
        return rows
    return rows.where(F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 30)) < int(limit / n * (1 << 30)))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    options: ToxicityOptions | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicityModel:
    """Fit a classifier from confirmed toxic texts and unlabelled ones outside the held-out fold.

    Confirmed are ids with a label of 1 in any row; every document of the fold, labelled or not, can
    be drawn as unlabelled. Both samples are bounded by the options, drawn by a hash of the id. Texts
    become sets of hashed features on the executors and only these reach the driver (a few KB per
    text), where numpy fits. Null ids and labels are ignored. Without confirmed texts, or without
    documents, the model gives each text the prior (0 if there is none to take).
    """
    options = options or ToxicityOptions()
    learnable = F.col("_id").isNotNull() & (fold(F.col("_id")) != 0)
    marks = (
        labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_toxic"))
        .where(learnable & F.col("_toxic").isNotNull())
        .groupBy("_id")
        .agg(F.max("_toxic").alias("_toxic"))
    )
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text")).where(learnable)
    ids = texts.select("_id").join(marks, "_id", "left")
    seen = ids.agg(
        F.count(F.lit(1)).alias("n"), F.count("_toxic").alias("labelled"), F.count_if(F.col("_toxic") == 1).alias("toxic")
    ).first()
    prior = options.prior
    if prior is None:
        prior = seen["toxic"] / seen["labelled"] if seen["labelled"] else 0.0
    none = np.zeros(1 << options.bits, np.float32)
    if not seen["toxic"] or not 0 < prior < 1:
        return ToxicityModel(options.bits, none, float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))))
    positive = _sampled(ids.where("_toxic = 1"), seen["toxic"], options.max_positive, options.seed)
    unlabelled = _sampled(ids, seen["n"], options.max_unlabelled, options.seed + 1)
    chosen = (
        positive.select("_id", F.lit(True).alias("_p"))
        .unionByName(unlabelled.select("_id", F.lit(False).alias("_p")))
        .groupBy("_id")
        .agg(F.bool_or("_p").alias("_p"), F.bool_or(~F.col("_p")).alias("_u"))
    )
    bits = options.bits

    def features(values: pa.Array) -> list[pa.Array]:
        return [pa.array([text_features(t or "", bits) for t in values.to_pylist()], pa.list_(pa.int32()))]

    # the sample is bounded by the options, so its ids may be broadcast
    sample = texts.join(F.broadcast(chosen), "_id")
    table = map_rows(sample, "text", struct_of(words=T.ArrayType(T.IntegerType())), features, keep_input=False).select("_id", "words", "_p", "_u")
    found = table.toArrow().sort_by("_id")
    lists = found.column("words").combine_chunks()
    values = lists.flatten().to_numpy()
    lengths = np.asarray(lists.value_lengths())
    is_p, is_u = (found.column(c).to_numpy() for c in ("_p", "_u"))
    n_p, n_u = int(is_p.sum()), int(is_u.sum())
    # features that confirmed texts have often, and more often than others, numbered from 0
    held, common = (np.bincount(values[np.repeat(x, lengths)], minlength=1 << bits) for x in (is_p, is_u))
    often = held >= max(min(options.min_texts, n_p), options.min_share * n_p)
    known = np.flatnonzero(often & (held * max(1, n_u) >= options.min_lift * common * n_p))
    number = np.full(1 << bits, -1, np.int32)
    number[known] = np.arange(len(known))
    kept = number[values] >= 0
    values, owner = number[values[kept]], np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[kept]
    del found, lists
    pa.default_memory_pool().release_unused()  # Arrow keeps what it has freed
    chosen_p, chosen_u = (
        Sets(values[x[owner]], (np.cumsum(x) - 1)[owner[x[owner]]], n) for x, n in ((is_p, n_p), (is_u, n_u))
    )
    weights, bias = fit_classifier(chosen_p, chosen_u, prior, len(known), options)
    none[known] = weights
    return ToxicityModel(bits, none, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, the chance that a text is toxic) and ``predicted`` (1 from 0.5 on).

    Whole texts are read; a null text scores as an empty one. Rows are scored alone without a
    shuffle; input columns of these names are replaced. The model has a fixed size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    remembered: dict[str, tuple[int, ...]] = {}

    def work(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        sums = np.empty(len(texts))
        for k, text in enumerate(texts.to_pylist()):
            found: set[int] = set()
            for w in set(_WORD.findall((text or "").lower())):
                weighty = remembered.get(w)
                if weighty is None:
                    if len(remembered) >= _REMEMBERED:
                        remembered.clear()
                    weighty = remembered[w] = tuple(h for h in word_features(w, m.bits) if m.weights[h])
                found.update(weighty)
            sums[k] = sum(float(m.weights[h]) for h in sorted(found)) + m.bias
        scores = _sigmoid(sums)
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

    return map_rows(docs, text_column, struct_of(score=T.DoubleType(), predicted=T.IntegerType()), work)
