"""Queries that build examples: lines, threads, question/answer records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.functions.split import split_label
from convspark.functions.text import is_trimmed, trim, word_count
from convspark.operators.lines import clean_lines
from convspark.operators.lines import line_examples as build_line_examples
from convspark.operators.ordering import shard_lines
from convspark.operators.qa import dedup_qa, flatten_qa
from convspark.operators.qa import qa_examples as build_qa_examples
from convspark.operators.threads import (
    linear_paths,
    normalise_comments,
    roots,
    unique_comments,
    usable,
    with_parent,
)
from convspark.operators.threads import thread_examples as build_thread_examples
from convspark.sources.qa_records import parse_qa_lines
from queries import inputs
from queries.registry import query

# ---- lines ----------------------------------------------------------------------------------

EXTRA = 10

LINE_EXAMPLES_CTE = (
    inputs.LINES_SQL
    + ","
    + inputs.CLEAN_SQL
    + """,
previous AS (
  SELECT file_id, line AS response, lag(line, 1) OVER w AS context, """
    + ", ".join(f'lag(line, {i + 2}) OVER w AS "context/{i}"' for i in range(EXTRA))
    + """ FROM clean WINDOW w AS (PARTITION BY file_id ORDER BY line_no)),
line_examples AS (
  SELECT * FROM previous WHERE length(response) BETWEEN 9 AND 127 AND length(context) BETWEEN 9 AND 127)"""
)


@query(f"WITH {LINE_EXAMPLES_CTE} SELECT * FROM line_examples")
def line_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_line_examples(inputs.lines(spark, sf_dir), EXTRA)


@query(f"WITH {LINE_EXAMPLES_CTE} SELECT * FROM line_examples")
def line_examples_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files far longer than a block: most lines take their contexts from the blocks before."""
    return build_line_examples(inputs.lines(spark, sf_dir), EXTRA, lines_per_block=7)


@query(f"WITH {inputs.LINES_SQL}, {inputs.CLEAN_SQL} SELECT file_id, line_no, line FROM clean")
def line_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(inputs.lines(spark, sf_dir))


@query(
    f"""WITH {inputs.LINES_SQL}, numbered AS (
  SELECT file_id AS source, line, row_number() OVER (ORDER BY file_id, line_no) - 1 AS n FROM lines),
letters AS (SELECT list_max([3] || list_filter(range(1, 13), lambda k: 26::HUGEINT ** (k - 1) <= max(n) // 100)) AS k
            FROM numbered)
SELECT source, line, n % 100 AS line_no, 'lines-' || array_to_string(list_transform(range(k - 1, -1, -1),
  lambda p: chr((97 + n // 100 // (26 ** p)::BIGINT % 26)::INT)), '') AS file_id FROM numbered, letters"""
)
def line_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = inputs.lines(spark, sf_dir).withColumnsRenamed({"file_id": "source", "line_no": "at"})
    return shard_lines(corpus, "source", "at", lines_per_shard=100).drop("at")


# ---- threads --------------------------------------------------------------------------------

MAX_LENGTH = 400


def trim_sql(c: str, limit: int) -> str:
    word = r"'[\p{L}\p{N}]'"
    return f"""CASE WHEN length({c}) <= {limit} THEN {c} ELSE substr({c}, 1, coalesce(list_max(list_filter(
      range(1, {limit} + 1), lambda p: regexp_matches(substr({c}, p::BIGINT, 1), {word})
                                    <> regexp_matches(substr({c}, p::BIGINT + 1, 1), {word}))), 0)::BIGINT) END"""


NORMAL_CTE = (
    inputs.COMMENTS_SQL
    + f""",
normal AS (
  SELECT id, regexp_replace(link_id, '^t[0-9]_', '') AS thread_id,
         regexp_replace(parent_id, '^t[0-9]_', '') AS parent_id,
         {trim_sql('body', MAX_LENGTH)} AS body, length(body) > {MAX_LENGTH} AS body_is_trimmed, author, subreddit
  FROM comments WHERE id IS NOT NULL AND link_id IS NOT NULL AND parent_id IS NOT NULL AND body IS NOT NULL)"""
)

# Walks from every comment to its ancestors; a walk that comes back to its start is a loop.
PATHS_CTE = """
walk AS (
  SELECT e.thread_id, e.id, p.id AS at, p.parent_id AS next, [p.id] AS ancestors
  FROM edges e JOIN edges p ON p.thread_id = e.thread_id AND p.id = e.parent_id WHERE e.id <> p.id
  UNION ALL
  SELECT w.thread_id, w.id, p.id, p.parent_id, list_append(w.ancestors, p.id)
  FROM walk w JOIN edges p ON p.thread_id = w.thread_id AND p.id = w.next
  WHERE NOT list_contains(w.ancestors, p.id) AND p.id <> w.id),
paths AS (
  SELECT thread_id, id, list_slice(ancestors, 1, 10) AS ancestors FROM walk w
  WHERE NOT EXISTS (SELECT 1 FROM edges p WHERE p.thread_id = w.thread_id AND p.id = w.next))"""


@query(f"WITH {NORMAL_CTE} SELECT * FROM normal")
def thread_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_comments(inputs.comments(spark, sf_dir), MAX_LENGTH)


@query(
    f"""WITH {inputs.COMMENTS_SQL}, twice AS (SELECT * FROM comments UNION ALL SELECT * FROM comments)
SELECT DISTINCT regexp_replace(link_id, '^t[0-9]_', '') AS thread_id, id, length(body)::BIGINT AS chars, author
FROM twice"""
)
def thread_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = normalise_comments(inputs.comments(spark, sf_dir), 2**30)
    return unique_comments(once.unionByName(once)).select(
        "thread_id", "id", F.length("body").cast("long").alias("chars"), "author"
    )


@query(
    f"""WITH {inputs.COMMENTS_SQL}, twice AS (SELECT * FROM comments UNION ALL
  SELECT id, link_id, parent_id, 'M ' || body, author, subreddit FROM comments)
SELECT regexp_replace(link_id, '^t[0-9]_', '') AS thread_id, id, min(body) AS body FROM twice GROUP BY ALL"""
)
def thread_unique_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a comment that differ: the first by content stays."""
    once = normalise_comments(inputs.comments(spark, sf_dir), 2**30)
    other = once.withColumn("body", F.concat(F.lit("M "), "body"))
    return unique_comments(once.unionByName(other)).select("thread_id", "id", "body")


@query(
    f"""SELECT doc_id, {trim_sql('text', 127)} AS trimmed_text, length(text) > 127 AS is_trimmed FROM documents
UNION ALL SELECT item_id, {trim_sql('text', 127)}, length(text) > 127 FROM benchmark"""
)
def thread_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    items = inputs.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return documents.unionByName(items).select(
        "doc_id", trim("text", 127).alias("trimmed_text"), is_trimmed("text", 127).alias("is_trimmed")
    )


@query(
    f"""WITH {inputs.EDGES_SQL}
SELECT thread_id, id FROM edges e
WHERE NOT EXISTS (SELECT 1 FROM edges p WHERE p.thread_id = e.thread_id AND p.id = e.parent_id)"""
)
def thread_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roots(inputs.edges_with_loops(spark, sf_dir)).select("thread_id", "id")


@query(
    f"""WITH {NORMAL_CTE}
SELECT c.thread_id, c.id, c.parent_id, p.author AS parent_author, p.body AS parent_body
FROM normal c JOIN normal p ON p.thread_id = c.thread_id AND p.id = c.parent_id"""
)
def thread_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = normalise_comments(inputs.comments(spark, sf_dir), MAX_LENGTH)
    return with_parent(comments, parent_author="author", parent_body="body").select(
        "thread_id", "id", "parent_id", "parent_author", "parent_body"
    )


@query(
    f"""WITH {NORMAL_CTE}
SELECT thread_id, id, NOT body_is_trimmed AND body NOT IN ('[deleted]', '[removed]') AND length(body) >= 9 AS usable
FROM normal"""
)
def thread_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = normalise_comments(inputs.comments(spark, sf_dir), MAX_LENGTH)
    return comments.select("thread_id", "id", usable(9).alias("usable"))


@query(
    f"""WITH RECURSIVE {inputs.EDGES_SQL}, {PATHS_CTE}
SELECT thread_id, id, len(ancestors)::INT AS depth, array_to_string(ancestors, '>') AS ancestors FROM paths"""
)
def thread_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_paths(inputs.edges_with_loops(spark, sf_dir), 10).select(
        "thread_id", "id", F.size("ancestors").alias("depth"), F.array_join("ancestors", ">").alias("ancestors")
    )


THREAD_EXAMPLES_CTE = (
    NORMAL_CTE
    + ", edges AS (SELECT thread_id, id, parent_id FROM normal), "
    + PATHS_CTE
    + """,
usable AS (
  SELECT * FROM normal
  WHERE NOT body_is_trimmed AND body NOT IN ('[deleted]', '[removed]') AND length(body) >= 9),
thread_examples AS (
  SELECT c.subreddit, c.thread_id, p.author AS context_author, c.author AS response_author,
         p.body AS context, c.body AS response, """
    + ", ".join(f'a{i}.body AS "context/{i}"' for i in range(9))
    + """
  FROM usable c JOIN paths t ON t.thread_id = c.thread_id AND t.id = c.id
  JOIN usable p ON p.thread_id = c.thread_id AND p.id = c.parent_id """
    + " ".join(
        f"LEFT JOIN normal a{i} ON a{i}.thread_id = c.thread_id AND a{i}.id = t.ancestors[{i + 2}]" for i in range(9)
    )
    + ")"
)


@query(f"WITH RECURSIVE {THREAD_EXAMPLES_CTE} SELECT * FROM thread_examples")
def thread_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_thread_examples(inputs.comments(spark, sf_dir), 10, 9, MAX_LENGTH)


# ---- question/answer records ----------------------------------------------------------------


@query(
    f"""WITH {inputs.QA_SQL}
SELECT product_id, question, answer, {inputs.word_count_sql('question')}::INT AS question_words,
       {inputs.word_count_sql('answer')}::INT AS answer_words FROM tuples"""
)
def qa_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_qa(inputs.qa_records(spark, sf_dir)).withColumns(
        {"question_words": word_count("question"), "answer_words": word_count("answer")}
    )


@query(
    f"""WITH {inputs.QA_SQL}
SELECT min(product_id) AS product_id, question, answer FROM tuples WHERE {inputs.QA_ACCEPTED_SQL} GROUP BY question, answer"""
)
def qa_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = flatten_qa(inputs.qa_records(spark, sf_dir), inputs.QA_MIN_WORDS, inputs.QA_MAX_WORDS)
    return dedup_qa(accepted).select("product_id", "question", "answer")


QA_EXAMPLES_CTE = f"""{inputs.QA_SQL},
qa_examples AS (
  SELECT min(product_id) AS product_id, question AS context, answer AS response
  FROM tuples WHERE {inputs.QA_ACCEPTED_SQL} GROUP BY question, answer)"""


@query(
    f"WITH {QA_EXAMPLES_CTE} SELECT *, {inputs.split_label_sql('product_id', 0.9)} AS split FROM qa_examples"
)
def qa_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = build_qa_examples(inputs.qa_records(spark, sf_dir), inputs.QA_MIN_WORDS, inputs.QA_MAX_WORDS)
    return built.withColumn("split", split_label("product_id"))


def _literal(c: Column) -> Column:
    """The text as a Python string literal in single quotes; texts without special characters stay plain."""
    out = c
    for raw, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit("'"), out, F.lit("'"))


@query(
    """SELECT (doc_id % 50)::VARCHAR AS product_id, source AS question, text AS answer FROM documents
UNION ALL SELECT 'c' || conv_id, text, role FROM conversations"""
)
def qa_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pieces(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    flat = inputs.table(spark, sf_dir, "documents").select(
        pieces(
            "{'asin': u", _literal((F.col("doc_id") % 50).cast("string")),
            ", 'question': ", _literal(F.col("source")), ", 'answer': ", _literal(F.col("text")), ", 'open': None}",
        ).alias("value")
    )
    nested = inputs.table(spark, sf_dir, "conversations").select(
        pieces(
            "{'asin': ", _literal(F.concat(F.lit("c"), F.col("conv_id"))),
            ", 'questions': [{'questionText': ", _literal(F.col("text")),
            ", 'answers': [{'answerText': ", _literal(F.col("role")), "}]}]}",
        ).alias("value")
    )
    # lines that are no record, have a value of a wrong type or a lone surrogate: none may give a row
    broken = inputs.table(spark, sf_dir, "documents").select(
        F.explode(
            F.array(
                F.lit("{'asin': 'p', 'question': 'q', 'answer'"),
                pieces("{'asin': u'p', 'question': ", _literal(F.col("text")), ", 'answer': 5}"),
                pieces("{'asin': u'p', 'questions': [{'questionText': ", _literal(F.col("source")), ", 'answers': [7]}]}"),
                F.lit("{'asin': 'p', 'question': u'\\ud800', 'answer': 'yes'}"),
            )
        ).alias("value")
    )
    return flatten_qa(parse_qa_lines(flat.unionByName(nested).unionByName(broken)))
