import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from convspark.operators.evaluate import accuracy, dedup_contexts, eval_batches, load_examples, recall_at_k
from convspark.operators.keyword import Bm25, TfIdf, document_frequency, documents
from convspark.operators.mapping import VectorMapping, _Map, _Setting, batch_gradient, dev_hits, mapping_gradient, pack_batches
from convspark.operators.ordering import dense_index
from convspark.operators.scoring import sparse_scores, unit_rows
from convspark.operators.vector import PRECOMPUTED, Encoder, MappingModel, VectorSimilarity, model_encoder
from convspark.params import EvalOptions
from convspark.plans.benchmark import evaluate, methods, sweep

# A golden case that the published results must agree with.
TRAIN = [("hello how are you", "hello how"), ("hello how are", "hello")]
PAIRS = "context string, response string"


def one_batch(spark, contexts, responses):
    kind = "string" if isinstance(contexts[0], str) else "array<float>"
    rows = [(0, i, i, c, r) for i, (c, r) in enumerate(zip(contexts, responses))]
    return spark.createDataFrame(
        rows, f"batch_id long, ctx_pos int, true_pos int, context {kind}, response {kind}"
    )


def predictions(model, batch):
    return [r.predicted_pos for r in model.rank_responses(batch).orderBy("ctx_pos").collect()]


@pytest.mark.parametrize(
    "ranker, contexts, responses, expected",
    [
        (TfIdf(), ["hello", "how", "are", "you"], ["you", "are", "how", "hello"], [3, 2, 1, 0]),
        (TfIdf(), ["hello you", "hello you"], ["hello", "you"], [1, 1]),
        (Bm25(), ["hello", "how", "are"], ["are", "how", "hello"], [2, 1, 0]),
    ],
)
def test_golden_keyword_rankings(spark, ranker, contexts, responses, expected):
    model = ranker.fit(spark.createDataFrame(TRAIN, PAIRS))
    assert predictions(model, one_batch(spark, contexts, responses)) == expected


def test_statistics_of_the_small_corpus(spark):
    train = spark.createDataFrame(TRAIN, PAIRS)
    found = {r.term: r.df for r in document_frequency(documents(train)).collect()}
    assert found == {"hello": 4, "how": 3, "are": 2, "you": 1}
    model = TfIdf().fit(train)
    docs = spark.createDataFrame([(1, "hello"), (2, "unseen"), (3, "you you how"), (4, "a")], "doc long, text string")
    weights = {(r.doc, r.term): r.weight for r in model.weights(docs, "doc").collect()}
    how, you = 1.2231435513, 2 * 1.9162907319
    norm = math.hypot(how, you)
    assert weights == pytest.approx({(1, "hello"): 1, (2, "unseen"): 1, (3, "you"): you / norm, (3, "how"): how / norm})


def bm25_by_hand(train, contexts, responses, k1=2.0, b=0.75):
    """Brute force on small lists, from the formulas alone."""

    def words(text):
        return [w for w in text.lower().split() if len(w) > 1]

    docs = [t for pair in train for t in pair]
    n, df = len(docs), Counter(w for d in docs for w in set(words(d)))

    def tfidf(text):
        raw = {w: c * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in Counter(words(text)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {w: v / norm for w, v in raw.items()}

    average = sum(sum(tfidf(d).values()) for d in docs) / n

    def bm25(text):
        w = tfidf(text)
        damping = k1 * (1 - b + b * sum(w.values()) / average)
        return {t: v * (k1 + 1) / (v + damping) * math.log((n - df[t] + 0.5) / (df[t] + 0.5)) for t, v in w.items()}

    sides = [[bm25(t) for t in texts] for texts in (contexts, responses)]
    return [[sum(v * r.get(t, 0) for t, v in c.items()) for r in sides[1]] for c in sides[0]]


def test_bm25_against_brute_force(spark):
    train = [("aa bb cc", "aa dd"), ("bb bb ee", "x"), ("ff", "aa gg hh"), ("x", "x"), ("aa bb cc", "aa dd")]
    contexts = ["aa bb", "zz aa", "", "gg hh bb bb", "ee"]
    responses = ["hh", "zz", "aa cc", "", "bb ee x"]
    ranked = Bm25().fit(spark.createDataFrame(train, PAIRS)).rank_responses(one_batch(spark, contexts, responses))
    wanted = np.array(bm25_by_hand(train, contexts, responses))
    rows = ranked.orderBy("ctx_pos").collect()
    assert [r.predicted_pos for r in rows] == wanted.round(9).argmax(axis=1).tolist()
    assert [r.score for r in rows] == pytest.approx(wanted.max(axis=1), abs=1e-8)


def test_sparse_scores_over_many_term_blocks():
    import pandas as pd

    rng = np.random.default_rng(0)
    dense = rng.random((2, 5, 9000)) * (rng.random((2, 5, 9000)) < 0.1)
    side, pos, term = dense.nonzero()
    weights = pd.DataFrame({"is_context": side == 0, "pos": pos, "term": term * 7919 - 5, "weight": dense[side, pos, term]})
    assert np.allclose(sparse_scores(5, weights.sample(frac=1, random_state=0)), dense[0] @ dense[1].T)


def test_golden_vector_similarity(spark):
    vectors = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 1.0, 1.0]]
    batch = one_batch(spark, vectors, vectors)
    assert predictions(VectorSimilarity(PRECOMPUTED).fit(batch), batch) == [0, 1, 2]


def test_zero_response_vector_scores_zero(spark):
    batch = one_batch(spark, [[1.0, 0.0], [-1.0, 0.0]], [[0.0, 0.0], [2.0, 0.0]])
    assert predictions(VectorSimilarity(PRECOMPUTED), batch) == [1, 0]


def test_model_encoder_batches_and_defaults(spark):
    def lengths(texts):
        assert len(texts) <= 3
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("a" * i, "b") for i in range(10)], PAIRS).coalesce(1)
    rows = model_encoder(lengths, batch_size=3).encode(df).collect()
    assert [r.context for r in rows] == [[float(i), 1.0] for i in range(10)]
    assert all(r.response == [1.0, 1.0] for r in rows)
    two = model_encoder(lengths, lambda texts: np.zeros((len(texts), 2)), 3).encode(df).first()
    assert two.response == [0.0, 0.0]


def planted(spark, n, dim, seed):
    rng = np.random.default_rng(seed)
    contexts = rng.normal(size=(n, dim)).astype("float32")
    rotation = np.linalg.qr(np.random.default_rng(99).normal(size=(dim, dim)))[0]
    responses = contexts @ rotation.T
    return spark.createDataFrame(
        list(zip(contexts.tolist(), responses.tolist())), "context array<float>, response array<float>"
    )


def test_map_learns_a_planted_rotation(spark):
    train, test = planted(spark, 400, 6, 1), planted(spark, 100, 6, 2)
    fit = VectorMapping(PRECOMPUTED, (3.0, 0.01), (0.0, 0.1), max_epochs=25).search(train)
    batches = eval_batches(dense_index(test), 50)
    plain = accuracy(VectorSimilarity(PRECOMPUTED).rank_responses(batches)).first()
    mapped = accuracy(fit.model.rank_responses(batches)).first()
    assert (plain.batches, mapped.batches, mapped.contexts) == (2, 2, 100)
    assert mapped.accuracy > 80 > 40 > plain.accuracy
    assert [t[:2] for t in fit.trials] == [(3.0, 0.0), (3.0, 0.1), (0.01, 0.0), (0.01, 0.1)]
    best = max(t[3] for t in fit.trials)
    assert best > 0.8 and all(1 <= t[2] <= 25 for t in fit.trials)


def rotated_pairs(n, dim, noise):
    """Responses are rotated contexts with noise."""
    rng = np.random.default_rng(11)
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    x = rng.normal(size=(n, dim))
    return x, x @ turn + noise * rng.normal(size=(n, dim))


def full_gradient_fit(contexts, responses, start, learning_rate, epochs):
    """Plain restatement: one Adagrad step per epoch on the mean gradient of all batches; dev accuracy of every epoch."""
    n_dev = -(-len(contexts) // 5)
    cuts = range(n_dev, len(contexts), 256)
    dev = [slice(a, min(a + 100, n_dev)) for a in range(0, n_dev, 100)]
    w, r, squares, r_squares, found = start.copy(), 1.0, np.full_like(start, 0.1), 0.1, []
    for _ in range(epochs):
        parts = [batch_gradient(contexts[a : a + 256], responses[a : a + 256], w, r)[:2] for a in cuts]
        by_w, by_r = (sum(p[k] for p in parts) / len(parts) for k in (0, 1))
        squares += by_w**2
        r_squares += by_r**2
        w, r = w - learning_rate * by_w / np.sqrt(squares), r - learning_rate * by_r / r_squares**0.5
        found.append(sum(dev_hits(contexts[d], responses[d], w, r) for d in dev) / n_dev)
    return found


@pytest.mark.parametrize("streams", [1, 4, None])
def test_local_steps_do_no_worse_than_full_gradients(spark, streams):
    x, y = rotated_pairs(6000, 12, 0.9)
    pairs = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y, strict=True)], "context array<double>, response array<double>")
    numbered = dense_index(pairs, 0).orderBy("ordinal").collect()
    contexts, responses = (unit_rows(np.array([r[c] for r in numbered])) for c in ("context", "response"))
    start = np.linalg.qr(np.random.default_rng(0).normal(size=(12, 12)))[0]
    whole = full_gradient_fit(contexts, responses, start, 0.3, 8)
    fit = VectorMapping(PRECOMPUTED, (0.3,), (0.0,), max_epochs=8, streams=streams).search(pairs)
    again = VectorMapping(PRECOMPUTED, (0.3,), (0.0,), max_epochs=8, streams=streams).search(pairs.repartition(5))
    assert fit.trials == again.trials  # neither the cluster nor the input's partitions change the fit
    assert fit.trials[0][3] >= max(whole) - 1e-9


def test_one_stream_is_stochastic_descent(spark):
    x, y = rotated_pairs(900, 5, 0.5)
    pairs = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(unit_rows(x), unit_rows(y), strict=True))], "ordinal long, context array<double>, response array<double>")
    batches, n_train = pack_batches(pairs, PRECOMPUTED)
    assert n_train == 3 and batches.count() == 5
    now = _Map.start(5, 0)
    contexts, responses = unit_rows(x), unit_rows(y)
    for a in (180, 436, 692):
        by_w, by_r, _ = batch_gradient(contexts[a : a + 256], responses[a : a + 256], now.weights, now.residual)
        now.step(by_w, by_r, 0.5, 0.01)
    stream = batches.repartitionById(1, F.lit(0)).sortWithinPartitions("is_dev", "batch")
    _, after = VectorMapping(PRECOMPUTED)._epoch(stream, {0: _Setting(0.5, 0.01, _Map.start(5, 0))})[0]
    assert np.allclose(after.numbers, now.numbers)


def test_one_pass_gradient(spark):
    x, y = rotated_pairs(700, 4, 0.5)
    contexts, responses = unit_rows(x), unit_rows(y)
    pairs = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))], "ordinal long, context array<double>, response array<double>")
    weights = np.arange(16.0).reshape(4, 4) / 10
    found = {(r.kind, r["row"], r.col): r.value for r in mapping_gradient(pack_batches(pairs, PRECOMPUTED)[0], weights, 0.5).collect()}
    parts = [batch_gradient(contexts[a : a + 256], responses[a : a + 256], weights, 0.5) for a in (140, 396, 652)]
    for i in range(4):
        for j in range(4):
            assert found["weights", i, j] == pytest.approx(np.mean([p[0][i, j] for p in parts]))
    assert found["residual", 0, 0] == pytest.approx(np.mean([p[1] for p in parts]))
    assert found["loss", 0, 0] == pytest.approx(np.mean([p[2] for p in parts]))
    hits = sum(dev_hits(contexts[a:b], responses[a:b], weights, 0.5) for a, b in ((0, 100), (100, 140)))
    assert found["dev_accuracy", 0, 0] == pytest.approx(hits / 140) and len(found) == 19
    empty = mapping_gradient(pack_batches(pairs.limit(0), PRECOMPUTED)[0], weights, 0.5)
    assert {r.value for r in empty.collect()} == {0.0}


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    x, y, w = unit_rows(rng.normal(size=(7, 4))), unit_rows(rng.normal(size=(7, 4))), rng.normal(size=(4, 4))
    by_weights, by_residual, loss = batch_gradient(x, y, w, 0.7)
    step = 1e-6
    for i, j in ((0, 0), (1, 3), (2, 1)):
        moved = w.copy()
        moved[i, j] += step
        assert (batch_gradient(x, y, moved, 0.7)[2] - loss) / step == pytest.approx(by_weights[i, j], abs=1e-4)
    assert (batch_gradient(x, y, w, 0.7 + step)[2] - loss) / step == pytest.approx(by_residual, abs=1e-4)


def test_mapping_model_scales_before_it_maps(spark):
    model = MappingModel(PRECOMPUTED, np.array([[0.0, 2.0], [0.0, 0.0]]), 1.0)
    batch = one_batch(spark, [[0.0, 3.0], [5.0, 0.0]], [[10.0, 0.0], [0.0, 0.5]])
    rows = model.rank_responses(batch).orderBy("ctx_pos").collect()
    # mapped responses: [1, 2] and [0, 1]
    assert [(r.predicted_pos, r.score) for r in rows] == [(0, 2.0), (0, 1.0)]


def test_batches_are_full_and_permuted(spark):
    pairs = spark.range(57).select(F.concat(F.lit("c"), "id").alias("context"), F.concat(F.lit("r"), "id").alias("response"))
    rows = eval_batches(dense_index(pairs), 10).collect()
    assert Counter(r.batch_id for r in rows) == {b: 10 for b in range(5)}
    for b in range(5):
        batch = [r for r in rows if r.batch_id == b]
        assert {r.ctx_pos for r in batch} == {r.true_pos for r in batch} == set(range(10))
        assert [r.ctx_pos for r in batch] != [r.true_pos for r in batch]
    assert len({r.context for r in rows}) == 50


def test_recall_grows_with_k_and_is_null_without_batches(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (1, 3), (1, 1)], "batch_id long, true_rank int")
    assert [recall_at_k(df, k).first().accuracy for k in (1, 2, 3)] == [50.0, 75.0, 100.0]
    empty = accuracy(df.where("batch_id > 5")).first()
    assert (empty.accuracy, empty.batches, empty.contexts) == (None, 0, 0)


def test_dedup_contexts_and_load(spark):
    df = spark.createDataFrame([("c", f"r{i}") for i in range(50)] + [("d", "r")], PAIRS)
    assert sorted(r.context for r in dedup_contexts(df).collect()) == ["c", "d"]
    assert load_examples(df, 10).count() == 10
    assert sorted(r.ordinal for r in load_examples(df, 100, deduplicate=True).collect()) == [0, 1]


def test_registry_and_sweep(spark):
    vector = Encoder(lambda c: F.array(F.length(c).cast("float"), F.lit(1.0).cast("float")))
    names = methods({"LEN": vector})
    assert list(names) == ["TF_IDF", "BM25", "LEN_SIM", "LEN_MAP"]
    pairs = spark.range(40).select(
        F.concat(F.lit("word"), F.col("id"), F.lit(" shared")).alias("context"),
        F.concat(F.lit("reply word"), F.col("id")).alias("response"),
    )
    options = EvalOptions(n_candidates=10, train_size=30, eval_num_batches=3)
    chosen = {n: names[n] for n in ("TF_IDF", "LEN_SIM")}
    rows = sweep({"toy": (pairs, pairs)}, chosen, options).collect()
    assert [(r.method, r.train, r.test, r.train_size, r.test_size, r.recall_k) for r in rows] == [
        ("TF_IDF", "toy-train", "toy-test", 30, 30, 10), ("LEN_SIM", "toy-train", "toy-test", 30, 30, 10)
    ]
    assert rows[0].accuracy == 100.0 and rows[1].accuracy < 50
    assert evaluate(Bm25(), pairs, pairs, options).first().accuracy == 100.0


def test_large_term_tables_are_cut_to_the_batch(spark, monkeypatch):
    """Beyond the size for a broadcast, terms are joined with those of the documents first; weights stay the same."""
    from convspark.operators import keyword
    from convspark.operators.keyword import Bm25, batch_terms

    examples = spark.range(60).selectExpr("concat('common word', id) context", "concat('reply common', id % 7) response")
    docs = spark.createDataFrame([(1, "common word3 unseen"), (2, None), (3, "reply")], "doc int, text string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        model = Bm25().fit(examples)
        assert model.n_docs == 120 and model.n_terms == model.terms.count()
        plain = sorted(map(tuple, model.weights(docs, "doc").collect()))
        monkeypatch.setattr(keyword, "BROADCAST_ROWS", 0)
        assert sorted(r.term for r in batch_terms(model.terms, model.n_terms, docs).collect()) == ["common", "reply", "word3"]
        cut = sorted(map(tuple, model.weights(docs, "doc").collect()))
    finally:
        spark.conf.set(key, before)
    assert [r[:2] for r in cut] == [r[:2] for r in plain] and all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(cut, plain))
