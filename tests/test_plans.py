"""Whole jobs: raw input to written set, and evaluation of what was written."""

import pytest

from convspark.functions.split import TEST, TRAIN
from convspark.operators.keyword import Bm25
from convspark.operators.ordering import shard_lines, shuffle_into_shards
from convspark.operators.qa import flatten_qa
from convspark.operators.stats import corpus_stats
from convspark.params import EvalOptions, LineOptions, QaOptions, ThreadOptions
from convspark.plans.benchmark import evaluate
from convspark.plans.datasets import line_dataset, qa_dataset, thread_dataset, write_dataset
from convspark.schema import QA_FEATURES, THREAD_FEATURES
from convspark.sources.example_sets import read_examples
from convspark.sources.text_lines import numbered_lines
from tests.test_qa import EXPECTED, RECORDS, tuples
from tests.test_threads import simple


@pytest.mark.parametrize("dataset_format", ["json", "tfrecord"])
def test_threads_to_files(spark, tmp_path, dicts, dataset_format):
    options = ThreadOptions(min_length=4, max_length=5, train_split=0.5, num_shards_train=2, num_shards_test=2,
                            dataset_format=dataset_format)
    comments = simple(spark, "t3_thread-A", "t3_testthread")
    path = str(tmp_path / "threads")
    assert write_dataset(thread_dataset(comments, options), path, options) == {"examples": 8, "train": 4, "test": 4}
    for split, thread in ((TRAIN, "thread-A"), (TEST, "testthread")):
        where = path + (f"/split={split}" if dataset_format == "json" else f"/{split}-*")
        found = dicts(read_examples(spark, where, dataset_format, 9, THREAD_FEATURES))
        assert {r["thread_id"] for r in found} == {thread} and len(found) == 4
        deepest = [r for r in found if "context/1" in r]
        assert deepest == [{"context/1": "AAAA", "context/0": "BBBB", "context": "DDDD", "response": "EEEE",
                            "context_author": "author-D", "response_author": "author-E",
                            "subreddit": "subreddit-A", "thread_id": thread}]


def test_qa_to_files(spark, tmp_path):
    from convspark.schema import QA_RECORD

    options = QaOptions(3, 5, 0.5, 2, 2, "json")
    records = spark.createDataFrame(RECORDS, QA_RECORD)
    dataset = qa_dataset(records, options)
    path = str(tmp_path / "qa")
    of_split = {split: sum(e[3] == split for e in EXPECTED) for split in (TRAIN, TEST)}
    counts = {"examples": len(EXPECTED), **of_split}
    assert write_dataset(dataset, path, options) == counts
    found = read_examples(spark, path, "json", 0, QA_FEATURES).collect()
    assert sorted((r.product_id, r.context, r.response) for r in found) == [e[:3] for e in EXPECTED]
    stats = corpus_stats(records, "asin", dataset, flatten_qa(records, 3, 5)).first().asDict()
    assert stats == {
        "inputs": len(RECORDS), "groups": len({r["asin"] for r in RECORDS}), "tuples": len(tuples(RECORDS, 3, 5)), **counts
    }


def test_one_long_file_is_cut_into_shards_first(spark, tmp_path):
    text = [f"line number {i} of the corpus" for i in range(1000)]
    (tmp_path / "corpus.txt").write_text("\n".join(text))
    lines = numbered_lines(spark, str(tmp_path / "corpus.txt"))
    shards = shard_lines(lines, "file_id", "line_no", lines_per_shard=300)
    dataset = line_dataset(shards, LineOptions(num_extra_contexts=1)).collect()
    assert {r.file_id for r in dataset} == {"lines-aaa", "lines-aab", "lines-aac", "lines-aad"}
    assert len(dataset) == 1000 - 4
    starts = sorted(int(r.context.split()[2]) for r in dataset if r["context/0"] is None)
    assert starts == [0, 300, 600, 900]


def test_a_written_set_can_be_evaluated(spark, tmp_path):
    lines = [("f%d" % (i // 20), i, f"topic{i // 2} shared words line {i}") for i in range(2000)]
    options = LineOptions(num_extra_contexts=1, train_split=0.5, num_shards_train=2, num_shards_test=2)
    path = str(tmp_path / "set")
    write_dataset(line_dataset(spark.createDataFrame(lines, "file_id string, line_no long, line string"), options), path, options)
    train, test = (read_examples(spark, f"{path}/{split}-*", "tfrecord", 1) for split in (TRAIN, TEST))
    result = evaluate(Bm25(), train, test, EvalOptions(n_candidates=20, eval_num_batches=10)).first()
    assert result.test_size == 200 and result.recall_k == 20
    assert 30 < result.accuracy < 100  # every other pair shares its topic


def test_an_unknown_split_is_an_error(spark):
    df = spark.createDataFrame([("a", "dev")], "t string, split string")
    with pytest.raises(Exception, match="split must be train or test"):
        shuffle_into_shards(df, 2, 2).collect()
