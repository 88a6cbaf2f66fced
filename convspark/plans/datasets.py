"""The three dataset jobs: build the examples, split them, write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from convspark.functions.split import assign_split
from convspark.operators.lines import line_examples
from convspark.operators.qa import counted_qa_examples, qa_examples
from convspark.operators.stats import observe_splits
from convspark.operators.threads import thread_examples
from convspark.params import LineOptions, QaOptions, ThreadOptions
from convspark.sources.example_sets import write_examples
from convspark.sources.qa_records import CORRUPT, corrupt_lines, parse_qa_lines, refuse_corrupt
from convspark.sources.text_lines import read_lines
from convspark.workspace import job_scope, materialise_counting


def thread_dataset(comments: DataFrame, options: ThreadOptions = ThreadOptions()) -> DataFrame:
    """Raw comments -> split examples; all comments of a thread share a split."""
    examples = thread_examples(comments, options.parent_depth, options.min_length, options.max_length)
    return assign_split(examples, "thread_id", options.train_split)


def line_dataset(lines: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """Numbered lines -> split examples; all lines of a file share a split."""
    examples = line_examples(lines, options.num_extra_contexts, options.min_length, options.max_length)
    return assign_split(examples, "file_id", options.train_split)


def qa_dataset(
    records: DataFrame, options: QaOptions = QaOptions(), unreadable: Observation | None = None
) -> DataFrame:
    """QA records -> split examples; the surviving product id decides the split.

    A line that could not be read (``_corrupt``) ends the job, unless ``unreadable`` is given: then
    such lines are left out and counted there, as ``corrupt``, by the job that writes the set.
    """
    if CORRUPT in records.columns:
        if unreadable is None:
            records = refuse_corrupt(records)
        else:
            records = records.observe(unreadable, F.count(CORRUPT).alias("corrupt"))
    return assign_split(qa_examples(records, options.min_words, options.max_words), "product_id", options.train_split)


def write_dataset(
    dataset: DataFrame, path: str, options: ThreadOptions | LineOptions | QaOptions
) -> dict[str, int]:
    """Write a split data set and return its example counts, observed by the same job."""
    observation = Observation()
    write_examples(
        observe_splits(dataset, observation),
        path,
        options.dataset_format,
        options.num_shards_train,
        options.num_shards_test,
    )
    return observation.get


def _write_rejects(rejects: DataFrame, path: str) -> None:
    """Beside the set: what could not be read, where it stands, and why."""
    rejects.write.parquet(path.rstrip("/") + "-rejects")


def build_thread_dataset(comments: DataFrame, path: str, options: ThreadOptions = ThreadOptions()) -> dict[str, int]:
    """Comments to a written set: comments read, threads, examples, train and test, counted by the job that writes.

    Intermediate tables are deleted at the end, here and in the other two jobs.
    """
    counts: dict[str, int] = {}
    with job_scope(comments.sparkSession):
        examples = thread_examples(comments, options.parent_depth, options.min_length, options.max_length, counts)
        return counts | write_dataset(assign_split(examples, "thread_id", options.train_split), path, options)


def build_line_dataset(spark: SparkSession, pattern: str, path: str, options: LineOptions = LineOptions()) -> dict[str, int]:
    """Files of lines to a written set: lines read, files, rejected lines, examples, train and test.

    Lines that are no UTF-8 are left out and written to ``<path>-rejects`` with their file, place and reason.
    """
    with job_scope(spark):
        found = read_lines(spark, pattern)
        written = write_dataset(line_dataset(found.lines, options), path, options)
        if found.counts["rejects"]:
            _write_rejects(found.rejects, path)
        return found.counts | written


def build_qa_dataset(spark: SparkSession, pattern: str, path: str, options: QaOptions = QaOptions()) -> dict[str, int]:
    """Files of records to a written set: lines read, products, tuples, rejected lines, examples, train and test.

    The files are parsed once, into a table; lines that are no UTF-8 or no record go to ``<path>-rejects`` with their
    file, place and reason.
    """
    with job_scope(spark):
        found = read_lines(spark, pattern)
        parsed, n = materialise_counting(parse_qa_lines(found.lines, "line"), "records", F.col(CORRUPT).isNotNull())
        before, after = Observation(), Observation()
        readable = parsed.where(F.col(CORRUPT).isNull())
        examples = counted_qa_examples(readable, options.min_words, options.max_words, before, after)
        written = write_dataset(assign_split(examples, "product_id", options.train_split), path, options)
        rejects = n + found.counts["rejects"]
        if rejects:
            _write_rejects(found.rejects.unionByName(corrupt_lines(parsed)), path)
        return before.get | after.get | {"rejects": rejects} | written
