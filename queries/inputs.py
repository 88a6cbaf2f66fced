"""How the driver tables are read as the inputs of the library: Spark and SQL side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.schema import RAW_COMMENT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lines: every line of every document; every third line gets a speaker name.


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .select(
            F.concat(F.lit("doc-"), F.col("doc_id")).alias("file_id"),
            F.col("line_no").cast("long").alias("line_no"),
            F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("matt: "), F.col("line")))
            .otherwise(F.col("line"))
            .alias("line"),
        )
    )


LINES_SQL = """
lines AS (
  SELECT 'doc-' || doc_id AS file_id, line_no, CASE WHEN line_no % 3 = 0 THEN 'matt: ' || line ELSE line END AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
        FROM documents))"""

def clean_line_sql(c: str) -> str:
    return rf"""trim(regexp_replace(regexp_replace({c},
             '(?:^|(?:[.!?][ \t\n\x0B\f\r]))([a-zA-Z0-9_]+):', '', 'g'),
             '[\[(]([^\n]*?)[\])]', '', 'g'), ' -' || chr(10))"""


CLEAN_SQL = f"""
clean AS (
  SELECT * FROM (
    SELECT file_id, line_no, {clean_line_sql('line')} AS line
    FROM lines) WHERE line <> '')"""


# Comments: one thread per conversation, replies branch at every third turn. Each thread also gets a
# loop of two comments, a comment that hangs off it, and a comment that answers itself.


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    back = F.when((F.col("turn") % 3 == 0) & (F.col("turn") > 0), 2).otherwise(1)
    return turns.select(
        F.concat(F.lit("m"), F.col("turn")).alias("id"),
        F.concat(F.lit("t3_"), F.col("conv_id")).alias("link_id"),
        F.when(F.col("turn") == 0, F.concat(F.lit("t3_"), F.col("conv_id")))
        .otherwise(F.concat(F.lit("t1_m"), F.col("turn") - back))
        .alias("parent_id"),
        F.col("text").alias("body"),
        F.col("role").alias("author"),
        (F.col("conv_id") % 7).cast("string").alias("subreddit"),
    ).to(RAW_COMMENT)


COMMENTS_SQL = """
comments AS (
  SELECT 'm' || turn AS id, 't3_' || conv_id AS link_id,
         CASE WHEN turn = 0 THEN 't3_' || conv_id
              ELSE 't1_m' || (turn - CASE WHEN turn % 3 = 0 THEN 2 ELSE 1 END) END AS parent_id,
         text AS body, role AS author, (conv_id % 7)::VARCHAR AS subreddit
  FROM conversations)"""

LOOPS = {"x1": "x2", "x2": "x1", "x3": "x3", "x4": "x1"}


def edges_with_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    from convspark.operators.threads import normalise_comments

    edges = normalise_comments(comments(spark, sf_dir)).select("thread_id", "id", "parent_id")
    first = table(spark, sf_dir, "conversations").where("turn = 0")
    loops = first.select(
        F.col("conv_id").cast("string").alias("thread_id"),
        F.explode(F.create_map(*[F.lit(x) for edge in LOOPS.items() for x in edge])).alias("id", "parent_id"),
    )
    return edges.unionByName(loops)


EDGES_SQL = (
    COMMENTS_SQL
    + """,
edges AS (
  SELECT regexp_replace(link_id, '^t[0-9]_', '') AS thread_id, id,
         regexp_replace(parent_id, '^t[0-9]_', '') AS parent_id FROM comments
  UNION ALL
  SELECT conv_id::VARCHAR, l.id, l.parent_id FROM conversations,
         (VALUES """
    + ", ".join(f"('{a}', '{b}')" for a, b in LOOPS.items())
    + """) l(id, parent_id) WHERE turn = 0)"""
)


# QA records: nested ones from blocks of four turns of a conversation (all user turns are questions,
# all assistant turns are answers), flat ones from documents (first line, whole text).


def qa_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    blocks = turns.groupBy("conv_id", F.floor(F.col("turn") / 4).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )

    def texts(role: str):
        return F.transform(F.filter("turns", lambda t: t["role"] == role), lambda t: t["text"])

    answers = F.transform(texts("assistant"), lambda a: F.struct(a.alias("answerText")))
    nested = blocks.select(
        (F.col("conv_id") % 50).cast("string").alias("asin"),
        F.lit(None).cast("string").alias("question"),
        F.lit(None).cast("string").alias("answer"),
        F.transform(
            texts("user"), lambda q: F.struct(q.alias("questionText"), answers.alias("answers"))
        ).alias("questions"),
    )
    flat = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 50).cast("string").alias("asin"),
        F.split("text", "\n", -1)[0].alias("question"),
        F.col("text").alias("answer"),
    )
    return nested.unionByName(flat, allowMissingColumns=True)


QA_SQL = """
tuples AS (
  SELECT (q.conv_id % 50)::VARCHAR AS product_id, q.text AS question, a.text AS answer
  FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND q.turn // 4 = a.turn // 4
  WHERE q.role = 'user' AND a.role = 'assistant'
  UNION ALL
  SELECT (doc_id % 50)::VARCHAR, string_split(text, chr(10))[1], text FROM documents)"""

QA_MIN_WORDS, QA_MAX_WORDS = 4, 400


def word_count_sql(c: str) -> str:
    return f"len(string_split({c}, ' '))"


QA_ACCEPTED_SQL = (
    f"{word_count_sql('question')} BETWEEN {QA_MIN_WORDS} AND {QA_MAX_WORDS} "
    f"AND {word_count_sql('answer')} BETWEEN {QA_MIN_WORDS} AND {QA_MAX_WORDS}"
)


# Pairs for the rankers: a turn and the next one; the conversation decides the split.


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.col("text").alias("context"), "response"
    )


PAIRS_SQL = """
pairs AS (
  SELECT c.conv_id, c.turn, c.text AS context, r.text AS response
  FROM conversations c JOIN conversations r ON c.conv_id = r.conv_id AND r.turn = c.turn + 1)"""


def split_pairs(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    from convspark.functions.split import split_label

    half = split_label(F.col("conv_id").cast("string"), 0.5)
    return pairs(spark, sf_dir).where(half == label).select("context", "response")


def split_value_sql(key: str) -> str:
    return f"(1 + ('0x' || right(md5({key}), 3))::INT) / 4096.0::DOUBLE"


def split_label_sql(key: str, share: float) -> str:
    return f"CASE WHEN {split_value_sql(key)} < {share} THEN 'train' ELSE 'test' END"


# Vectors: neighbours in the table form a pair.


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    first = F.col("vec_id") % 2 == 0
    return (
        vectors.groupBy(F.floor(F.col("vec_id") / 2).alias("pair"))
        .agg(
            F.max(F.when(first, F.col("embedding"))).alias("context"),
            F.max(F.when(~first, F.col("embedding"))).alias("response"),
        )
        .dropna()
    )


VECTOR_PAIRS_SQL = """
vpairs AS (
  SELECT c.vec_id // 2 AS pair, c.embedding::DOUBLE[] AS context, r.embedding::DOUBLE[] AS response
  FROM embeddings c JOIN embeddings r ON r.vec_id = c.vec_id + 1 WHERE c.vec_id % 2 = 0)"""


def digest_sql(seed: int, *columns: str) -> str:
    return f"md5(concat_ws(chr(31), '{seed}', {', '.join(f'{c}::VARCHAR' for c in columns)}))"
