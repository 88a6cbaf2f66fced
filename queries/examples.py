"""Queries over example sets: splits, samples, shuffles, sinks and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.functions.examples import fixed_width as fill_width
from convspark.functions.examples import mix, render_example, serialize_example
from convspark.functions.split import assign_split, split_label, split_value
from convspark.operators.ordering import dense_index as add_ordinal
from convspark.operators.ordering import sample_n as sample
from convspark.operators.ordering import shuffle_into_shards
from convspark.operators.qa import flatten_qa
from convspark.operators.stats import corpus_stats as count_corpus
from convspark.operators.stats import count_examples, split_stats as count_splits
from convspark.schema import LINE_FEATURES, QA_FEATURES
from convspark.sources.comments import union_months
from convspark.sources.example_sets import read_examples, write_examples
from convspark.workspace import new_path
from queries import inputs
from queries.datasets import EXTRA, LINE_EXAMPLES_CTE, QA_EXAMPLES_CTE, line_examples, qa_examples
from queries.registry import query

LABEL_SQL = inputs.split_label_sql("file_id", 0.9)
EXTRAS_SQL = ", ".join(f'"context/{i}"' for i in range(EXTRA))


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_split(line_examples(spark, sf_dir), "file_id")


SPLIT_LINES_CTE = f"{LINE_EXAMPLES_CTE}, split_lines AS (SELECT *, {LABEL_SQL} AS split FROM line_examples)"


@query(
    f"""WITH {LINE_EXAMPLES_CTE}
SELECT file_id, context, response, {inputs.split_value_sql('file_id')} AS split_value, {LABEL_SQL} AS split
FROM line_examples"""
)
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_examples(spark, sf_dir).select(
        "file_id",
        "context",
        "response",
        split_value("file_id").alias("split_value"),
        split_label("file_id").alias("split"),
    )


COUNTS_SQL = "count(*) AS examples, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test"


@query(f"WITH {SPLIT_LINES_CTE} SELECT {COUNTS_SQL} FROM split_lines")
def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_splits(split_lines(spark, sf_dir))


@query(
    f"""WITH {SPLIT_LINES_CTE}
SELECT (SELECT count(*) FROM lines) AS inputs, (SELECT count(DISTINCT file_id) FROM lines) AS "groups", {COUNTS_SQL}
FROM split_lines"""
)
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_corpus(inputs.lines(spark, sf_dir), "file_id", split_lines(spark, sf_dir))


QA_LABEL_SQL = inputs.split_label_sql("product_id", 0.9)


@query(
    f"""WITH {QA_EXAMPLES_CTE}, split_qa AS (SELECT {QA_LABEL_SQL} AS split FROM qa_examples),
records AS (SELECT conv_id % 50 AS asin FROM conversations GROUP BY conv_id, turn // 4
            UNION ALL SELECT doc_id % 50 FROM documents)
SELECT (SELECT count(*) FROM records) AS inputs, (SELECT count(DISTINCT asin) FROM records) AS "groups",
       (SELECT count(*) FROM tuples WHERE {inputs.QA_ACCEPTED_SQL}) AS tuples, {COUNTS_SQL} FROM split_qa"""
)
def qa_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.qa_records(spark, sf_dir)
    tuples = flatten_qa(records, inputs.QA_MIN_WORDS, inputs.QA_MAX_WORDS)
    return count_corpus(records, "asin", qa_examples(spark, sf_dir), tuples)


@query(f"WITH {QA_EXAMPLES_CTE} SELECT count(*) AS examples FROM qa_examples")
def example_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_examples(qa_examples(spark, sf_dir))


@query(
    """SELECT event_id, user_id, event_type, strftime(ts, '%Y_%m_%d') AS part FROM events
WHERE regexp_matches(strftime(ts, '%Y_%m_%d'), '^201[5678]_[01][0-9]_[0-9]+$|^2024_01_[01][0-9]$')"""
)
def month_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyy_MM_dd").alias("part")
    )
    return union_months(events, "^201[5678]_[01][0-9]_[0-9]+$|^2024_01_[01][0-9]$", "part")


@query(
    f"""WITH {LINE_EXAMPLES_CTE}, {QA_EXAMPLES_CTE}
SELECT file_id, NULL AS product_id, context, response, {EXTRAS_SQL} FROM line_examples
UNION ALL SELECT NULL, product_id, context, response, {', '.join(['NULL'] * EXTRA)} FROM qa_examples"""
)
def mix_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(line_examples(spark, sf_dir), qa_examples(spark, sf_dir).drop("split"))


FILLED_SQL = ", ".join(f"""coalesce("context/{i}", '') AS "context/{i}\"""" for i in range(EXTRA))


@query(
    f"""WITH {LINE_EXAMPLES_CTE}
SELECT context, response, {FILLED_SQL}, '' AS "context/{EXTRA}", '' AS "context/{EXTRA + 1}" FROM line_examples"""
)
def fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_width(line_examples(spark, sf_dir), EXTRA + 2)


DIGEST_SQL = inputs.digest_sql(7, "context", "response")


@query(
    f"""WITH {LINE_EXAMPLES_CTE}, short AS (SELECT context, response FROM line_examples)
SELECT context, response FROM short ORDER BY {DIGEST_SQL}, context, response LIMIT 500"""
)
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(line_examples(spark, sf_dir).select("context", "response"), 500, seed=7)


@query(
    f"""WITH {LINE_EXAMPLES_CTE}, short AS (SELECT context, response FROM line_examples)
SELECT context, response, row_number() OVER (ORDER BY {DIGEST_SQL}, context, response) - 1 AS ordinal FROM short"""
)
def dense_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_ordinal(line_examples(spark, sf_dir).select("context", "response"), seed=7)


@query(f"WITH {SPLIT_LINES_CTE} SELECT split, file_id, context, response, {EXTRAS_SQL} FROM split_lines")
def shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_into_shards(split_lines(spark, sf_dir), 16, 4)


SHORT_EXTRAS_SQL = ", ".join(f'"context/{i}"' for i in range(EXTRA))
ROUND_TRIP_SQL = f"WITH {SPLIT_LINES_CTE} SELECT context, response, {SHORT_EXTRAS_SQL}, file_id FROM split_lines"


def _round_trip(spark: SparkSession, sf_dir: str, dataset_format: str) -> DataFrame:
    path = new_path(spark, f"examples-{dataset_format}")
    write_examples(split_lines(spark, sf_dir), path, dataset_format, 8, 2)
    return read_examples(spark, path, dataset_format, EXTRA, LINE_FEATURES)


@query(ROUND_TRIP_SQL)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


@query(ROUND_TRIP_SQL)
def tfrecord_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "tfrecord")


def _field_sql(name: str, value: str, indent: str) -> str:
    shown = f"replace({value}, chr(10), chr(92) || 'n ')"
    return f"'{indent}[{name}]:' || chr(10) || '{indent}' || chr(9) || {shown} || chr(10)"


_RENDERED_EXTRAS = " || ".join(
    f"""coalesce({_field_sql(f'context/{i}', f'"context/{i}"', chr(9))}, '')""" for i in reversed(range(EXTRA))
)


@query(
    f"""WITH {LINE_EXAMPLES_CTE}
SELECT {_field_sql('Context', 'context', '')} || {_field_sql('Response', 'response', '')}
  || CASE WHEN "context/0" IS NULL THEN '' ELSE chr(10) || 'Extra Contexts:' || chr(10) || {_RENDERED_EXTRAS} END
  || chr(10) || 'Other features:' || chr(10) || {_field_sql('file_id', 'file_id', chr(9))} AS rendered
FROM line_examples"""
)
def render(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = line_examples(spark, sf_dir)
    return examples.select(render_example(examples.columns).alias("rendered"))


# Record bytes as hex digits. Lengths below 128 take one byte, longer ones two or three.
def _varint_sql(n: str) -> str:
    def byte(e: str) -> str:
        return f"printf('%02X', ({e})::BIGINT)"

    return (
        f"CASE WHEN {n} < 128 THEN {byte(n)} "
        f"WHEN {n} < 16384 THEN {byte(f'{n} % 128 + 128')} || {byte(f'{n} // 128')} "
        f"ELSE {byte(f'{n} % 128 + 128')} || {byte(f'{n} // 128 % 128 + 128')} || {byte(f'{n} // 16384')} END"
    )


def _delimited_sql(tag: str, payload: str) -> str:
    """For a list element x: tag, byte count, payload."""
    size = f"(length({payload}) // 2)"
    return f"'{tag}' || {_varint_sql(size)} || {payload}"


_NAMED = ", ".join(f"{{'k': '{n}', 'v': {n}}}" for n in ("context", "product_id", "response"))


@query(
    f"""WITH {QA_EXAMPLES_CTE},
named AS (SELECT product_id, context, response, [{_NAMED}] AS f FROM qa_examples),
hexed AS (SELECT * REPLACE (list_transform(f, lambda x: {{'k': hex(encode(x.k)), 'v': hex(encode(x.v))}}) AS f) FROM named),
listed AS (SELECT * REPLACE (list_transform(f, lambda x: {{'k': x.k, 'v': {_delimited_sql('0A', 'x.v')}}}) AS f) FROM hexed),
valued AS (SELECT * REPLACE (list_transform(f, lambda x: {{'k': x.k, 'v': {_delimited_sql('0A', 'x.v')}}}) AS f) FROM listed),
entered AS (SELECT * REPLACE (list_transform(f, lambda x: {_delimited_sql('0A', 'x.k')} || {_delimited_sql('12', 'x.v')}) AS f) FROM valued),
entries AS (SELECT * REPLACE (list_transform(f, lambda x: {_delimited_sql('0A', 'x')}) AS f) FROM entered),
joined AS (SELECT *, array_to_string(f, '') AS x FROM entries)
SELECT product_id, context, response, {_delimited_sql('0A', 'x')} AS record FROM joined"""
)
def serialize_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ["context", "response", *QA_FEATURES]
    return qa_examples(spark, sf_dir).select(*features, F.hex(serialize_example(features)).alias("record"))


@query(
    """SELECT event_id, user_id, strftime(ts, 'd%Y_%m_%d') AS day FROM events
WHERE regexp_matches(strftime(ts, 'd%Y_%m_%d'), '^d2024_01_0[1-9]$')"""
)
def day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of a partitioned table: only their folders are read."""
    events = inputs.table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.date_format("ts", "'d'yyyy_MM_dd").alias("day")
    )
    path = new_path(spark, "events-by-day")
    events.write.partitionBy("day").parquet(path)
    return union_months(spark.read.parquet(path), "^d2024_01_0[1-9]$", "day")
