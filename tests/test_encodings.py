"""Encoders as tables, shared encodings, and products cut into blocks."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from convspark.operators import scoring
from convspark.operators.evaluate import eval_batches
from convspark.operators.keyword import Bm25, TfIdf
from convspark.operators.ordering import dense_index
from convspark.operators.scoring import unit_rows
from convspark.operators.vector import PRECOMPUTED, Encoder, LookupEncoder, MappingModel, VectorSimilarity, encode_once, model_encoder
from convspark.params import EvalOptions
from convspark.plans.benchmark import VectorMethod, evaluate, methods, sweep

PAIRS = "context string, response string"
VECTORS = [("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [3.0, 4.0]), ("c", [3.0, 5.0]), (None, [9.0, 9.0]), ("e", None)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(VECTORS, "text string, embedding array<float>")


def found(df):
    return sorted((r.n, r.context and list(r.context), r.response and list(r.response)) for r in df.collect())


def test_texts_are_looked_up(spark, table):
    examples = spark.createDataFrame([(1, "a", "b"), (2, "c", "a"), (3, "a", "b")], f"n int, {PAIRS}")
    encoded = LookupEncoder(table).encode(examples)
    assert encoded.columns == ["n", "context", "response"]
    assert found(encoded) == [(1, [1, 0], [0, 2]), (2, [3, 4], [1, 0]), (3, [1, 0], [0, 2])]


def test_texts_without_a_vector(spark, table):
    examples = spark.createDataFrame([(1, "a", "b"), (2, "x", "a"), (3, "a", None), (4, "e", "y")], f"n int, {PAIRS}")
    with pytest.raises(Exception, match="no vector"):
        LookupEncoder(table).encode(examples).collect()
    zero = [(1, [1, 0], [0, 2]), (2, [0, 0], [1, 0]), (3, [1, 0], [0, 0]), (4, [0, 0], [0, 0])]
    assert found(LookupEncoder(table, missing="zero").encode(examples)) == zero
    assert found(LookupEncoder(table, missing="drop").encode(examples)) == zero[:1]
    assert found(LookupEncoder(table.limit(0), missing="zero").encode(examples.limit(1))) == [(1, [], [])]
    with pytest.raises(ValueError):
        LookupEncoder(table, missing="ignore")


def test_a_hot_text_is_split(spark, table):
    """A third of 60,000 contexts share a text; without a broadcast the join is still spread over tasks."""
    words = spark.range(40_000).select(F.concat(F.lit("t"), "id").alias("text"), F.array(F.col("id").cast("float")).alias("embedding"))
    hot = spark.createDataFrame([("hot", [-1.0])], words.schema)
    examples = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 40_000)).alias("context"),
        F.concat(F.lit("t"), F.col("id") % 40_000).alias("response"), F.repeat(F.lit("x"), 50).alias("more"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        [encoded] = encode_once(LookupEncoder(words.unionByName(hot)), examples)
        encoded.persist()
        total = encoded.agg(F.count("*"), F.count_if(F.col("context")[0] == -1), F.sum(F.col("response")[0])).first()
        plan = encoded._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    encoded.unpersist()
    wanted = sum(i % 40_000 for i in range(60_000))
    assert tuple(total) == (60_000, 20_000, float(wanted))
    assert "skew=true" in plan


def test_every_distinct_text_is_encoded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def lengths(texts):
        seen.add(len(texts))
        return np.array([[len(t), t.count("o"), 1.0] for t in texts])

    train = [(f"how old {i % 7}", f"so old {i % 5}") for i in range(300)]
    test = [(f"how old {i % 11}", f"so old {i % 5}" if i % 9 else None) for i in range(300)]
    sides = tuple(spark.createDataFrame(rows, PAIRS).repartition(4) for rows in (train, test))
    rankers = methods({"LEN": model_encoder(lengths)})
    rankers["LEN_FIXED"] = VectorMethod(rankers["LEN_SIM"].encoder, lambda e: MappingModel(e, np.eye(3), 0.5))
    del rankers["LEN_MAP"]
    rows = {r.method: r for r in sweep({"d": sides}, rankers, EvalOptions(n_candidates=10)).collect()}
    texts = {t or "" for pair in train + test for t in pair}
    assert seen.value == len(texts)
    alone = evaluate(VectorSimilarity(model_encoder(lambda ts: np.array([[len(t or ""), (t or "").count("o"), 1.0] for t in ts]))), *sides, EvalOptions(n_candidates=10)).first()
    assert rows["LEN_SIM"].accuracy == alone.accuracy and rows["LEN_SIM"].test_size == 300 and len(rows) == 4


def test_two_sided_encoders_keep_their_sides(spark):
    encoder = Encoder(lambda t: F.array(F.length(t).cast("float")), lambda t: F.array(-F.length(t).cast("float")))
    [encoded] = encode_once(encoder, spark.createDataFrame([(1, "aa", "b"), (2, "b", "aa")], f"n int, {PAIRS}"))
    assert found(encoded) == [(1, [2], [-1]), (2, [1], [-2])]


def test_a_sweep_numbers_what_is_left_after_drops(spark, table):
    rng = random.Random(2)
    rows = [(rng.choice("abcx"), rng.choice("abc")) for _ in range(400)]
    sides = (spark.createDataFrame(rows, PAIRS),) * 2
    method = VectorMethod(LookupEncoder(table, missing="drop"), VectorSimilarity)
    [row] = sweep({"d": sides}, {"L": method}, EvalOptions(n_candidates=10)).collect()
    left = sum(c != "x" for c, _ in rows)
    assert row.train_size == row.test_size == left and row.accuracy is not None


@pytest.mark.parametrize("block", [1, 3, 7, 10, 50])
def test_blocks_rank_like_one_product(spark, block):
    rng = random.Random(block)
    words = "a0 b1 c2 d3 e4 f5 same same".split()
    texts = [(" ".join(rng.choices(words, k=4)), " ".join(rng.choices(words, k=3))) for _ in range(60)]
    examples = spark.createDataFrame(texts, PAIRS)
    batches = eval_batches(dense_index(examples), 10).cache()
    order = ["batch_id", "ctx_pos"]
    for ranker in (TfIdf(), Bm25()):
        model = ranker.fit(examples)
        whole, cut = (model.rank_responses(batches, n, block).orderBy(order).collect() for n in (None, 10))
        assert [r[:5] for r in whole] == [r[:5] for r in cut] and len(cut) == 60
        assert [r.score for r in whole] == pytest.approx([r.score for r in cut])
    vectors = batches.withColumns({c: F.array(*[F.size(F.split(F.col(c), w)).cast("float") for w in words[:6]]) for c in ("context", "response")})
    for model in (VectorSimilarity(PRECOMPUTED), VectorSimilarity(PRECOMPUTED, False), MappingModel(PRECOMPUTED, np.eye(6)[::-1], 0.1)):
        whole, cut = (model.rank_responses(vectors, n, block).orderBy(order).collect() for n in (None, 10))
        assert [r[:5] for r in whole] == [r[:5] for r in cut]


def test_twenty_thousand_candidates(spark):
    """One batch of 20,000: a single product would have 3.2 GB of scores."""
    n, dim = 20_000, 6
    rng = np.random.default_rng(5)
    contexts = rng.integers(-3, 4, (n, dim)).astype(float)
    responses = np.roll(contexts, 1, axis=1) + rng.integers(-1, 2, (n, dim))  # small whole numbers: many ties
    place = rng.permutation(n)
    rows = [(0, int(place[i]), i, contexts[i].tolist(), responses[i].tolist()) for i in range(n)]
    batch = spark.createDataFrame(rows, "batch_id long, ctx_pos int, true_pos int, context array<float>, response array<float>")
    ranked = VectorSimilarity(PRECOMPUTED).rank_responses(batch, n)
    result = {r.true_pos: (r.ctx_pos, r.predicted_pos, r.true_rank) for r in ranked.collect()}
    assert len(result) == n
    unit = unit_rows(responses)
    for i in range(0, n, 997):
        scores = np.round(unit @ contexts[i], 9) + 0.0
        ahead = (scores > scores[i]) | ((scores == scores[i]) & (np.arange(n) < i))
        assert result[i] == (place[i], scores.argmax(), ahead.sum() + 1)


def test_small_batches_are_ranked_many_to_a_call(spark, monkeypatch):
    """A call a batch, or a block of one, took most of the time; ranks are those of the batches alone."""
    rng = random.Random(6)
    words = "a0 b1 c2 d3 e4 f5 same same".split()
    texts = [(" ".join(rng.choices(words, k=rng.randrange(4))), " ".join(rng.choices(words, k=3))) for _ in range(300)]
    examples = spark.createDataFrame(texts, PAIRS)
    model = Bm25().fit(examples)
    full = eval_batches(dense_index(examples), 10)
    short = full.where("batch_id % 3 > 0 OR (ctx_pos < 4 AND true_pos < 4)").where("batch_id > 1 OR ctx_pos = true_pos")
    renumbered = short.withColumns({c: F.expr(f"row_number() OVER (PARTITION BY batch_id ORDER BY {c}) - 1").cast("int") for c in ("ctx_pos", "true_pos")})
    for batches in (full.cache(), renumbered.cache()):
        alone, *together = (
            {(r.batch_id, r.ctx_pos): (r.true_pos, r.predicted_pos, r.true_rank, round(r.score, 9)) for r in model.rank_responses(batches, n, block).collect()}
            for n, block in ((None, 10), (10, 10), (10, 3))
        )
        assert alone and all(found == alone for found in together)
    for found in (model.rank_responses(full, 10), model.rank_responses(full, 10, 3)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "pack" in plan
    monkeypatch.setattr(scoring, "_PAIRS", 3)
    left = pd.DataFrame({"group": [0, 0, 1, 1], "pos": [0, 1, 2, 2], "term": [5, 5, 5, 6], "weight": [1.0, 2.0, 3.0, 4.0]})
    right = pd.DataFrame({"group": [0, 0, 1, 2], "pos": [0, 1, 0, 0], "term": [5, 5, 6, 6], "weight": [1.0, 10.0, 5.0, 7.0]})
    assert scoring.grouped_scores((3, 2), left, right).tolist() == [[1, 10], [2, 20], [20, 0]]
