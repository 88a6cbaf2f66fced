"""Lines that cannot be read do not vanish from a data set in silence."""

import pytest
from pyspark.sql import Observation

from convspark.params import QaOptions
from convspark.plans.datasets import qa_dataset, write_dataset
from convspark.sources.qa_records import read_qa_records

GOOD = [r"""{'asin': 'p', 'question': u'😀 is it blue', 'answer': 'yes it is blue'}""", "{'asin': 'q', 'question': 'how tall is it', 'answer': 'about a metre high'}"]
BAD = ["no literal", "{'asin': u'p', 'question': 'how wide is it', 'answer': 5}", r"""{'asin': 'p', 'question': u'\ud800', 'answer': 'yes'}"""]


def test_unreadable_lines_end_the_job_or_are_counted(spark, tmp_path):
    (tmp_path / "qa.txt").write_text("\n".join(GOOD + BAD) + "\n")
    records = read_qa_records(spark, str(tmp_path / "qa.txt"))
    options = QaOptions(dataset_format="json", num_shards_train=1, num_shards_test=1)
    with pytest.raises(Exception, match="unreadable record"):
        write_dataset(qa_dataset(records, options), str(tmp_path / "a"), options)
    lost = Observation()
    counts = write_dataset(qa_dataset(records, options, lost), str(tmp_path / "b"), options)
    assert counts["examples"] == 2 and lost.get["corrupt"] == 3
    (tmp_path / "fine.txt").write_text("\n".join(GOOD) + "\n")
    fine = qa_dataset(read_qa_records(spark, str(tmp_path / "fine.txt")), options)
    assert write_dataset(fine, str(tmp_path / "c"), options)["examples"] == 2
