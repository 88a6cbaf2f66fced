"""Queries that score and evaluate: keyword and vector rankers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.operators import evaluate
from convspark.operators.keyword import (
    Bm25,
    KeywordModel,
    TfIdf,
    bm25_idf,
    document_frequency,
    documents,
    smoothed_idf,
    term_counts,
)
from convspark.operators.mapping import VectorMapping, mapping_gradient, pack_batches
from convspark.operators.ordering import dense_index
from convspark.operators.scoring import BLOCK
from convspark.operators.vector import PRECOMPUTED, LookupEncoder, MappingModel, VectorSimilarity, model_encoder
from convspark.params import EvalOptions
from convspark.plans.benchmark import VectorMethod, methods
from convspark.plans.benchmark import evaluate as run_evaluation
from convspark.plans.benchmark import sweep as run_sweep
from convspark.sources.example_sets import append_results
from convspark.workspace import materialise, new_path
from queries import inputs
from queries.datasets import QA_EXAMPLES_CTE, qa_examples
from queries.registry import query

N = 10
TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
HALF = inputs.split_label_sql("conv_id::VARCHAR", 0.5)

# ---- terms ----------------------------------------------------------------------------------

TURNS_CTE = "docs AS (SELECT conv_id, turn, text FROM conversations)"
PAIR_DOCS_CTE = (
    inputs.PAIRS_SQL + ", docs AS (SELECT context AS text FROM pairs UNION ALL SELECT response FROM pairs)"
)
TERMS_CTE = f"""
terms AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({TOKENS_SQL})) AS term FROM docs) GROUP BY term),
size AS (SELECT count(*)::DOUBLE AS n FROM docs)"""


@query(
    f"""WITH {TURNS_CTE}
SELECT conv_id, turn, term, count(*) AS tf FROM (SELECT conv_id, turn, unnest({TOKENS_SQL}) AS term FROM docs)
GROUP BY conv_id, turn, term"""
)
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts(inputs.table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query(f"WITH {PAIR_DOCS_CTE}, {TERMS_CTE} SELECT term, df FROM terms")
def doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_frequency(documents(inputs.pairs(spark, sf_dir)))


@query(
    f"""WITH {PAIR_DOCS_CTE}, {TERMS_CTE}
SELECT term, round(ln((1 + n) / (1 + df)) + 1, 6) AS smoothed_idf, round(ln((n - df + 0.5) / (df + 0.5)), 6) AS bm25_idf
FROM terms, size"""
)
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = inputs.pairs(spark, sf_dir)
    model = TfIdf().fit(pairs)
    n_docs = model.n_docs
    return model.terms.select(
        "term",
        F.round(smoothed_idf(F.col("df"), n_docs), 6).alias("smoothed_idf"),
        F.round(bm25_idf(F.col("df"), n_docs), 6).alias("bm25_idf"),
    )


def weights_cte(source: str, key: str) -> str:
    """TF-IDF weights of ``source(key.., text)`` as ``weighed``."""
    return f"""
counted AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({TOKENS_SQL}) AS term FROM {source})
            GROUP BY {key}, term),
raw AS (SELECT c.*, coalesce(df, 0) AS df, tf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) AS r
        FROM counted c LEFT JOIN terms USING (term), size),
weighed AS (SELECT {key}, term, df, r / sqrt(sum(r * r) OVER (PARTITION BY {key})) AS w FROM raw)"""


# Mean over all training documents of the sum of their weights.
AVERAGE_CTE = f"""
train_docs AS (SELECT row_number() OVER () AS d, text FROM docs),
tc AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest({TOKENS_SQL}) AS term FROM train_docs) GROUP BY d, term),
tr AS (SELECT d, tf * (ln((1 + n) / (1 + df)) + 1) AS r FROM tc JOIN terms USING (term), size),
tw AS (SELECT r / sqrt(sum(r * r) OVER (PARTITION BY d)) AS w FROM tr),
average AS (SELECT (SELECT sum(w) FROM tw) / (SELECT n FROM size) AS average_length)"""


def bm25_cte(key: str) -> str:
    return f"""
lengthy AS (SELECT {key}, term, df, w, sum(w) OVER (PARTITION BY {key}) AS length FROM weighed),
bm25 AS (SELECT {key}, term,
           w * 3.0 / (w + 2.0 * (0.25 + 0.75 * length / average_length)) * ln((n - df + 0.5) / (df + 0.5)) AS w
         FROM lengthy, size, average)"""


def _turn_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")


def _rounded(model: KeywordModel, docs: DataFrame) -> DataFrame:
    weights = model.weights(docs, "conv_id", "turn")
    return weights.select("conv_id", "turn", "term", F.round("weight", 6).alias("weight"))


TURN_SOURCE_CTE = "turns AS (SELECT conv_id, turn, text FROM conversations)"


@query(
    f"""WITH {PAIR_DOCS_CTE}, {TERMS_CTE}, {TURN_SOURCE_CTE}, {weights_cte('turns', 'conv_id, turn')}
SELECT conv_id, turn, term, round(w, 6) AS weight FROM weighed"""
)
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(TfIdf().fit(inputs.pairs(spark, sf_dir)), _turn_docs(spark, sf_dir))


@query(
    f"""WITH {PAIR_DOCS_CTE}, {TERMS_CTE}, {AVERAGE_CTE}, {TURN_SOURCE_CTE},
{weights_cte('turns', 'conv_id, turn')}, {bm25_cte('conv_id, turn')}
SELECT conv_id, turn, term, round(w, 6) AS weight FROM bm25"""
)
def bm25_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(Bm25().fit(inputs.pairs(spark, sf_dir)), _turn_docs(spark, sf_dir))


# ---- batches and rankings -------------------------------------------------------------------


def batches_cte(test: str, digest: str, order: str) -> str:
    """Full batches of N with permuted contexts, as ``placed``."""
    return f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY {digest}, {order}) - 1 AS ordinal FROM {test}),
full_batches AS (SELECT *, ordinal // {N} AS batch_id, (ordinal % {N})::INT AS true_pos FROM numbered
                 QUALIFY count(*) OVER (PARTITION BY ordinal // {N}) = {N}),
placed AS (SELECT *, (row_number() OVER (PARTITION BY batch_id
             ORDER BY md5(concat_ws(':', 'permute-0', true_pos::VARCHAR, batch_id::VARCHAR)), true_pos) - 1)::INT AS ctx_pos
           FROM full_batches)"""


#: From ``scored(batch_id, ctx_pos, resp_pos, score)``: ranks with ties to the first candidate.
RANKED_CTE = """
grid AS (SELECT c.batch_id, c.ctx_pos, c.true_pos, r.true_pos AS resp_pos FROM placed c JOIN placed r USING (batch_id)),
ranks AS (SELECT g.*, coalesce(round(score, 9), 0) + 0.0 AS score FROM grid g LEFT JOIN scored s
          ON s.batch_id = g.batch_id AND s.ctx_pos = g.ctx_pos AND s.resp_pos = g.resp_pos),
ordered AS (SELECT *, row_number() OVER (PARTITION BY batch_id, ctx_pos ORDER BY score DESC, resp_pos) AS place FROM ranks),
ranked AS (SELECT batch_id, ctx_pos, true_pos, min(resp_pos) FILTER (place = 1) AS predicted_pos,
             (min(place) FILTER (resp_pos = true_pos))::INT AS true_rank, max(score) AS score
           FROM ordered GROUP BY batch_id, ctx_pos, true_pos)"""

RANKED_SQL = "SELECT batch_id, ctx_pos, true_pos, predicted_pos, true_rank, round(score, 6) AS score FROM ranked"


def accuracy_sql(k: int = 1) -> str:
    return f"""SELECT round(100.0 * avg(share), 6) AS accuracy, count(*) AS batches, sum(m)::BIGINT AS contexts
FROM (SELECT avg((true_rank <= {k})::INT) AS share, count(*) AS m FROM ranked GROUP BY batch_id)"""


def keyword_ctes(train: str, test: str, method: str) -> str:
    """All steps from the train and test pairs to ``ranked``."""
    key = "batch_id, is_context, pos"
    final = "weighed" if method == "TF_IDF" else "bm25"
    return ", ".join(
        filter(
            None,
            [
                f"docs AS (SELECT context AS text FROM {train} UNION ALL SELECT response FROM {train})",
                TERMS_CTE,
                AVERAGE_CTE if method == "BM25" else "",
                batches_cte(test, inputs.digest_sql(0, "context", "response"), "context, response"),
                """sides AS (SELECT batch_id, true AS is_context, ctx_pos AS pos, context AS text FROM placed
                   UNION ALL SELECT batch_id, false, true_pos, response FROM placed)""",
                weights_cte("sides", key),
                bm25_cte(key) if method == "BM25" else "",
                f"""scored AS (SELECT c.batch_id, c.pos AS ctx_pos, r.pos AS resp_pos, sum(c.w * r.w) AS score
                   FROM {final} c JOIN {final} r ON c.batch_id = r.batch_id AND c.term = r.term
                   WHERE c.is_context AND NOT r.is_context GROUP BY ALL)""",
                RANKED_CTE,
            ],
        )
    )


SPLIT_CTE = f"""{inputs.PAIRS_SQL},
train AS (SELECT context, response FROM pairs WHERE {HALF} = 'train'),
test AS (SELECT context, response FROM pairs WHERE {HALF} = 'test')"""


def _keyword_ranked(spark: SparkSession, sf_dir: str, ranker: TfIdf | Bm25, block: int = BLOCK) -> DataFrame:
    model = ranker.fit(inputs.split_pairs(spark, sf_dir, "train"))
    test = dense_index(inputs.split_pairs(spark, sf_dir, "test"))
    return model.rank_responses(materialise(evaluate.eval_batches(test, N), "batches"), N, block)


def _rounded_score(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn("score", F.round("score", 6))


def _rounded_accuracy(result: DataFrame) -> DataFrame:
    return result.withColumn("accuracy", F.round("accuracy", 6))


@query(
    f"""WITH {SPLIT_CTE}, {batches_cte('test', inputs.digest_sql(0, 'context', 'response'), 'context, response')}
SELECT batch_id, ctx_pos, true_pos, context, response FROM placed"""
)
def eval_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.eval_batches(dense_index(inputs.split_pairs(spark, sf_dir, "test")), N)


@query(f"WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'TF_IDF')} {RANKED_SQL}")
def tfidf_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_score(_keyword_ranked(spark, sf_dir, TfIdf()))


@query(f"WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'BM25')} {RANKED_SQL}")
def bm25_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_score(_keyword_ranked(spark, sf_dir, Bm25()))


@query(f"WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'BM25')} {RANKED_SQL}")
def bm25_rank_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranks from blocks of three contexts and three candidates, merged."""
    return _rounded_score(_keyword_ranked(spark, sf_dir, Bm25(), block=3))


@query(f"WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'TF_IDF')} {accuracy_sql()}")
def tfidf_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_accuracy(evaluate.accuracy(_keyword_ranked(spark, sf_dir, TfIdf())))


@query(f"WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'BM25')} {accuracy_sql()}")
def bm25_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_accuracy(evaluate.accuracy(_keyword_ranked(spark, sf_dir, Bm25())))


@query(f"WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'BM25')} {accuracy_sql(3)}")
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_accuracy(evaluate.recall_at_k(_keyword_ranked(spark, sf_dir, Bm25()), 3))


# Many replies per context: the language of a document with each of its texts.
DEDUP_DIGEST = inputs.digest_sql(0, "context", "response")


@query(
    f"""WITH many AS (SELECT lang || ' ' || source AS context, text AS response FROM documents),
seen AS (SELECT *, {DEDUP_DIGEST} AS d FROM many
         QUALIFY row_number() OVER (PARTITION BY context ORDER BY {DEDUP_DIGEST}, response) = 1)
SELECT context, response, row_number() OVER (ORDER BY d, context, response) - 1 AS ordinal FROM seen"""
)
def eval_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    many = inputs.table(spark, sf_dir, "documents").select(
        F.concat_ws(" ", "lang", "source").alias("context"), F.col("text").alias("response")
    )
    return evaluate.load_examples(many, deduplicate=True)


# ---- vectors --------------------------------------------------------------------------------

VECTOR_BATCHES_CTE = (
    inputs.VECTOR_PAIRS_SQL + ", " + batches_cte("vpairs", inputs.digest_sql(0, "pair"), "pair")
)


def _vector_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = dense_index(inputs.vector_pairs(spark, sf_dir), key=["pair"], unique=True)
    return evaluate.eval_batches(indexed, N)


def dot_sql(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"


def unit_sql(v: str) -> str:
    return f"list_transform({v}, lambda e: e / sqrt(list_sum(list_transform({v}, lambda q: q * q))))"


def vector_ctes(context: str, response: str) -> str:
    """From the transformed vectors of each side to ``ranked``."""
    return f"""{VECTOR_BATCHES_CTE},
c AS (SELECT batch_id, ctx_pos, {context} AS v FROM placed),
r AS (SELECT batch_id, true_pos AS resp_pos, {response} AS v FROM placed),
scored AS (SELECT batch_id, ctx_pos, resp_pos, {dot_sql('c.v', 'r.v')} AS score FROM c JOIN r USING (batch_id)),
{RANKED_CTE}"""


@query(f"WITH {vector_ctes('context', unit_sql('response'))} {RANKED_SQL}")
def vec_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_score(VectorSimilarity(PRECOMPUTED).rank_responses(_vector_batches(spark, sf_dir)))


@query(f"WITH {vector_ctes('context', unit_sql('response'))} {RANKED_SQL}")
def vec_rank_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranks from products of four contexts by four candidates, merged."""
    ranked = VectorSimilarity(PRECOMPUTED).rank_responses(_vector_batches(spark, sf_dir), N, block=4)
    return _rounded_score(ranked)


@query(f"WITH {vector_ctes('context', 'response')} {accuracy_sql()}")
def vec_dot_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = VectorSimilarity(PRECOMPUTED, normalise=False).rank_responses(_vector_batches(spark, sf_dir))
    return _rounded_accuracy(evaluate.accuracy(ranked))


# A fixed map, so that both sides compute the same scores.
DIM, RESIDUAL = 64, 0.5


def mapped_sql(dim: int) -> str:
    return f"""list_transform(range(1, {dim + 1}), lambda j: {RESIDUAL} * u[j] + list_sum(list_transform(
  range(1, {dim + 1}), lambda i: u[i] * ((((i - 1) * 7 + (j - 1) * 3) % 11 - 5) / 10.0::DOUBLE))))"""


def fixed_map(dim: int) -> np.ndarray:
    i, j = np.indices((dim, dim))
    return ((i * 7 + j * 3) % 11 - 5) / 10.0


MAPPED_SQL = mapped_sql(DIM)


@query(
    f"""WITH {VECTOR_BATCHES_CTE},
c AS (SELECT batch_id, ctx_pos, {unit_sql('context')} AS v FROM placed),
units AS (SELECT batch_id, true_pos AS resp_pos, {unit_sql('response')} AS u FROM placed),
r AS (SELECT batch_id, resp_pos, {MAPPED_SQL} AS v FROM units),
scored AS (SELECT batch_id, ctx_pos, resp_pos, {dot_sql('c.v', 'r.v')} AS score FROM c JOIN r USING (batch_id)),
{RANKED_CTE} {RANKED_SQL}"""
)
def vec_map_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = MappingModel(PRECOMPUTED, fixed_map(DIM), RESIDUAL)
    return _rounded_score(model.rank_responses(_vector_batches(spark, sf_dir)))


# One pass of the fit at the fixed map: softmax within batches of 256, a fifth of the pairs kept apart in batches of 100.
GRADIENT_SQL = f"""WITH {inputs.VECTOR_PAIRS_SQL},
ordered AS (SELECT {unit_sql('context')} AS c, {unit_sql('response')} AS u,
  row_number() OVER (ORDER BY {inputs.digest_sql(0, 'pair')}) - 1 AS ordinal, ceil(0.2 * count(*) OVER ())::BIGINT AS n_dev FROM vpairs),
dealt AS (SELECT c, u, {MAPPED_SQL} AS m, ordinal, ordinal < n_dev AS dev,
  CASE WHEN ordinal < n_dev THEN ordinal // 100 ELSE (ordinal - n_dev) // 256 END AS batch FROM ordered),
scored AS (SELECT a.dev, a.batch, a.ordinal AS x, b.ordinal AS y, a.c, b.u, {dot_sql('a.c', 'b.m')} AS s
           FROM dealt a JOIN dealt b ON a.dev = b.dev AND a.batch = b.batch),
soft AS (SELECT *, count(*) OVER (PARTITION BY batch, x) AS n, s - ln(sum(exp(s)) OVER (PARTITION BY batch, x)) AS share
         FROM scored WHERE NOT dev),
aimed AS (SELECT *, 0.2::DOUBLE / n + CASE WHEN x = y THEN 0.8::DOUBLE ELSE 0 END AS target FROM soft),
pulled AS (SELECT batch, y, j, any_value(u) AS u, sum((exp(share) - target) / n * c[j]) AS g
           FROM aimed, (SELECT unnest(range(1, {DIM + 1})) AS j) GROUP BY batch, y, j),
size AS (SELECT count(DISTINCT batch)::DOUBLE AS batches FROM soft),
best AS (SELECT x, arg_max(y, (s, -y)) = x AS hit FROM scored WHERE dev GROUP BY x)
SELECT 'weights' AS kind, (i - 1)::INT AS row, (j - 1)::INT AS col, round(sum(u[i] * g) / any_value(batches), 7) AS value
FROM pulled, (SELECT unnest(range(1, {DIM + 1})) AS i), size GROUP BY i, j
UNION ALL SELECT 'residual', 0, 0, round(sum(u[j] * g) / any_value(batches), 7) FROM pulled, size
UNION ALL SELECT 'loss', 0, 0, round(sum(-target * share / n) / any_value(batches), 7) FROM aimed, size
UNION ALL SELECT 'dev_accuracy', 0, 0, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 7) FROM best"""


@query(GRADIENT_SQL)
def vec_map_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = dense_index(inputs.vector_pairs(spark, sf_dir), key=["pair"], unique=True)
    batches, _ = pack_batches(numbered, PRECOMPUTED)
    found = mapping_gradient(batches, fixed_map(DIM), RESIDUAL)
    return found.withColumn("value", F.round("value", 7) + 0.0)


@query()
def vec_map_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = inputs.vector_pairs(spark, sf_dir).select("context", "response")
    fit = VectorMapping(PRECOMPUTED).search(pairs)
    rows = [(float(lr), float(reg), epoch, accuracy) for lr, reg, epoch, accuracy in fit.trials]
    return spark.createDataFrame(
        rows, "learning_rate double, regularizer double, best_epoch int, dev_accuracy double"
    )


LETTERS = "aeinorst"
LETTERS_SQL = f"""list_append(list_transform({list(LETTERS)}, lambda l: (length({{0}})
  - length(replace({{0}}, l, '')))::DOUBLE), 1.0::DOUBLE)"""


def _letter_counts(texts: list[str]) -> np.ndarray:
    return np.array([[*(t.count(c) for c in LETTERS), 1] for t in texts], dtype="float32")


@query(
    f"""WITH {SPLIT_CTE}, {batches_cte('test', inputs.digest_sql(0, 'context', 'response'), 'context, response')},
c AS (SELECT batch_id, ctx_pos, {LETTERS_SQL.format('context')} AS v FROM placed),
u AS (SELECT batch_id, true_pos AS resp_pos, {LETTERS_SQL.format('response')} AS v FROM placed),
r AS (SELECT batch_id, resp_pos, {unit_sql('v')} AS v FROM u),
scored AS (SELECT batch_id, ctx_pos, resp_pos, {dot_sql('c.v', 'r.v')} AS score FROM c JOIN r USING (batch_id)),
{RANKED_CTE} {RANKED_SQL}"""
)
def encoder_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts through a user's encoder, here counts of letters."""
    batches = evaluate.eval_batches(dense_index(inputs.split_pairs(spark, sf_dir, "test")), N)
    return _rounded_score(VectorSimilarity(model_encoder(_letter_counts)).rank_responses(batches))


# A table of embeddings by text, without one for every sixteenth text; such texts have the zero vector.
LOOKUP_CTE = f"""{SPLIT_CTE}, {batches_cte('test', inputs.digest_sql(0, 'context', 'response'), 'context, response')},
known AS (SELECT text, embedding::DOUBLE[] AS vector FROM (SELECT DISTINCT text FROM conversations WHERE left(md5(text), 1) <> '0') t
  JOIN embeddings ON vec_id = ('0x' || right(md5(text), 6))::BIGINT % (SELECT count(*) FROM embeddings)),
c AS (SELECT batch_id, ctx_pos, vector AS v FROM placed JOIN known ON text = context),
r AS (SELECT batch_id, true_pos AS resp_pos, {unit_sql('vector')} AS v FROM placed JOIN known ON text = response),
scored AS (SELECT batch_id, ctx_pos, resp_pos, {dot_sql('c.v', 'r.v')} AS score FROM c JOIN r USING (batch_id)),
{RANKED_CTE}"""


def _embeddings_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = inputs.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    digest = F.md5("text")
    texts = inputs.table(spark, sf_dir, "conversations").select("text").distinct().where(~digest.startswith("0"))
    number = F.conv(F.right(digest, F.lit(6)), 16, 10).cast("long") % vectors.count()
    return texts.withColumn("vec_id", number).join(vectors, "vec_id").select("text", "embedding")


@query(f"WITH {LOOKUP_CTE} {RANKED_SQL}")
def encoder_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts by a table of embeddings; a third of all turns may share one text."""
    batches = evaluate.eval_batches(dense_index(inputs.split_pairs(spark, sf_dir, "test")), N)
    encoder = LookupEncoder(_embeddings_by_text(spark, sf_dir), missing="zero")
    return _rounded_score(VectorSimilarity(encoder).rank_responses(materialise(batches, "batches")))


# ---- data sets by methods -------------------------------------------------------------------

SWEEP_OPTIONS = EvalOptions(n_candidates=N)
QA_HALF = inputs.split_label_sql("product_id", 0.5)
QA_SPLIT_CTE = f"""{QA_EXAMPLES_CTE},
train AS (SELECT context, response FROM qa_examples WHERE {QA_HALF} = 'train'),
test AS (SELECT context, response FROM qa_examples WHERE {QA_HALF} = 'test')"""


def _sweep_sql(dataset: str, splits: str, method: str) -> str:
    return f"""SELECT * FROM (WITH {splits}, {keyword_ctes('train', 'test', method)}
SELECT '{method}' AS method, '{dataset}-train' AS train, '{dataset}-test' AS test,
  (SELECT count(*) FROM train) AS train_size, (SELECT count(*) FROM test) AS test_size,
  {N}::BIGINT AS recall_k, accuracy FROM ({accuracy_sql()}))"""


def _sweep_data(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    from convspark.functions.split import split_label

    turns = [inputs.split_pairs(spark, sf_dir, label) for label in ("train", "test")]
    built = materialise(qa_examples(spark, sf_dir).withColumn("split", split_label("product_id", 0.5)), "qa")
    qa = [built.where(F.col("split") == label).select("context", "response") for label in ("train", "test")]
    return {"turns": (turns[0], turns[1]), "qa": (qa[0], qa[1])}


def _vector_sweep_sql(dataset: str, splits: str, method: str) -> str:
    """Accuracy of counts of letters, as they are or with both sides scaled and the responses mapped."""
    context, response = ("v", "u") if method == "LETTERS_SIM" else (unit_sql("v"), mapped_sql(len(LETTERS) + 1))
    return f"""SELECT * FROM (WITH {splits},
{batches_cte('test', inputs.digest_sql(0, 'context', 'response'), 'context, response')},
cv AS (SELECT batch_id, ctx_pos, {LETTERS_SQL.format('context')} AS v FROM placed),
c AS (SELECT batch_id, ctx_pos, {context} AS v FROM cv),
rv AS (SELECT batch_id, true_pos AS resp_pos, {LETTERS_SQL.format('response')} AS w FROM placed),
units AS (SELECT batch_id, resp_pos, {unit_sql('w')} AS u FROM rv),
r AS (SELECT batch_id, resp_pos, {response} AS v FROM units),
scored AS (SELECT batch_id, ctx_pos, resp_pos, {dot_sql('c.v', 'r.v')} AS score FROM c JOIN r USING (batch_id)),
{RANKED_CTE}
SELECT '{method}' AS method, '{dataset}-train' AS train, '{dataset}-test' AS test,
  (SELECT count(*) FROM train) AS train_size, (SELECT count(*) FROM test) AS test_size,
  {N}::BIGINT AS recall_k, accuracy FROM ({accuracy_sql()}))"""


@query(
    " UNION ALL ".join(
        _vector_sweep_sql(dataset, splits, method)
        for dataset, splits in (("turns", SPLIT_CTE), ("qa", QA_SPLIT_CTE))
        for method in ("LETTERS_SIM", "LETTERS_FIXED_MAP")
    )
)
def sweep_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two methods over one encoder, which sees each distinct text of a data set once."""
    letters = model_encoder(_letter_counts)
    weights = fixed_map(len(LETTERS) + 1)
    rankers = {
        "LETTERS_SIM": VectorMethod(letters, VectorSimilarity),
        "LETTERS_FIXED_MAP": VectorMethod(letters, lambda encoder: MappingModel(encoder, weights, RESIDUAL)),
    }
    return _rounded_accuracy(run_sweep(_sweep_data(spark, sf_dir), rankers, SWEEP_OPTIONS))


@query(
    " UNION ALL ".join(
        _sweep_sql(dataset, splits, method)
        for dataset, splits in (("turns", SPLIT_CTE), ("qa", QA_SPLIT_CTE))
        for method in ("TF_IDF", "BM25")
    )
)
def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rankers: dict[str, Callable] = {"TF_IDF": TfIdf, "BM25": Bm25}
    return _rounded_accuracy(run_sweep(_sweep_data(spark, sf_dir), rankers, SWEEP_OPTIONS))


@query(
    f"""WITH {SPLIT_CTE}, {keyword_ctes('train', 'test', 'BM25')}
SELECT 'BM25' AS method, (SELECT count(*) FROM train) AS train_size, (SELECT count(*) FROM test) AS test_size,
  accuracy FROM ({accuracy_sql()})"""
)
def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A method of the registry, evaluated, its row appended to a file of results and read again."""
    train, test = (inputs.split_pairs(spark, sf_dir, label) for label in ("train", "test"))
    result = run_evaluation(methods()["BM25"](), train, test, SWEEP_OPTIONS)
    path = new_path(spark, "results")
    append_results(result.select(F.lit("BM25").alias("method"), "train_size", "test_size", "accuracy"), path)
    schema = "method string, train_size long, test_size long, accuracy double"
    return _rounded_accuracy(spark.read.schema(schema).option("header", True).csv(path))
