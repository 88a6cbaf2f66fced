import random
import re

import pytest

from convspark.functions.split import assign_split
from convspark.operators.lines import line_examples
from convspark.schema import LINES
from convspark.sources.text_lines import numbered_lines

# A golden case that the published results must agree with.
TRAIN = ["matt: AAAA", "[skip]", "BBBB", "", "", "CCCC", "(all laughing)", "c3po:", "- DDDD (boom!)", "123", "12345"]
TEST = ["", "aaaa", "bbbb", "cccc", "dddd"]


def expected(file_id, split, a, b, c, d):
    same = {"file_id": file_id, "split": split}
    return [
        {**same, "context": a, "response": b},
        {**same, "context/0": a, "context": b, "response": c},
        {**same, "context/1": a, "context/0": b, "context": c, "response": d},
    ]


def in_order(rows):
    return sorted(rows, key=lambda r: sorted(r.items()))


def lines_frame(spark, files):
    rows = [(f, i, line) for f, lines in files.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, LINES)


def test_golden_from_files(spark, tmp_path, dicts):
    for name, lines in (("input_train.txt", TRAIN), ("input_test.txt", TEST)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    lines = numbered_lines(spark, str(tmp_path / "input_*.txt"))
    found = dicts(assign_split(line_examples(lines, min_length=4, max_length=5), "file_id", 0.5))
    assert found == in_order(
        expected("input_train.txt", "train", "AAAA", "BBBB", "CCCC", "DDDD")
        + expected("input_test.txt", "test", "aaaa", "bbbb", "cccc", "dddd")
    )


def test_no_matching_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        numbered_lines(spark, str(tmp_path / "nothing-*"))


def test_line_numbers_over_many_splits(spark, tmp_path):
    rng = random.Random(1)
    files = {f"f{k}.txt": [f"{k} line {i} " + "x" * rng.randint(0, 90) for i in range(4000)] for k in range(2)}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        rows = numbered_lines(spark, str(tmp_path / "*.txt")).collect()
    finally:
        spark.conf.set(key, before)
    found = {name: [r.line for r in sorted(rows, key=lambda r: r.line_no) if r.file_id == name] for name in files}
    assert found == files
    assert {r.line_no for r in rows} == set(range(4000))


def test_bytes_that_are_no_text_are_an_error(spark, tmp_path):
    (tmp_path / "bad.txt").write_bytes(b"good line\n\xff\xfe\n")
    with pytest.raises(Exception, match="not valid UTF-8"):
        numbered_lines(spark, str(tmp_path / "bad.txt"))


def pairs_by_list(lines, extra, low, high):
    """Brute force over one file."""
    kept = []
    for line in lines:
        line = re.sub(r"(?:^|[.!?]\s)[a-zA-Z0-9_]+:", "", line)
        line = re.sub(r"[\[(].*?[\])]", "", line).strip(" -\n")
        if line:
            kept.append(line)
    out = []
    for i in range(1, len(kept)):
        if low <= len(kept[i]) <= high and low <= len(kept[i - 1]) <= high:
            example = {"context": kept[i - 1], "response": kept[i]}
            example.update({f"context/{j}": kept[i - 2 - j] for j in range(extra) if i - 2 - j >= 0})
            out.append(example)
    return out


@pytest.mark.parametrize("lines_per_block", [1, 2, 7, 100_000])
def test_blocks_do_not_change_the_result(spark, dicts, lines_per_block):
    rng = random.Random(lines_per_block)
    pool = ["", "", "-", "[x]", "bob: hi", "ok", "a good line", "another good line", "(sigh) well then", "z" * 40]
    files = {f"file-{k}": [f"{rng.choice(pool)}" for _ in range(n)] for k, n in enumerate((0, 1, 3, 60, 150))}
    found = line_examples(lines_frame(spark, files), 3, 4, 20, lines_per_block)
    wanted = [{"file_id": f, **e} for f, lines in files.items() for e in pairs_by_list(lines, 3, 4, 20)]
    assert dicts(found) == in_order(wanted)


def test_plan_has_no_python_and_moves_the_text_once(spark):
    plan = line_examples(lines_frame(spark, {"f": TRAIN}))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Python" not in physical and "Arrow" not in physical
    assert "hashpartitioning(file_id" in physical


def test_files_with_a_path_are_shuffled_once(spark, tmp_path):
    """Texts moved twice where the label is not the key: the branch of the blocks' ends had an exchange without it."""
    rows = [(f"/{d}/x", "x", i, f"line {i} of {d} is here") for d in "ab" for i in range(30)]
    spark.createDataFrame(rows, "path string, file_id string, line_no long, line string").write.parquet(f"{tmp_path}/lines")
    made = line_examples(spark.read.parquet(f"{tmp_path}/lines").where("path IS NOT NULL"), 2, lines_per_block=10)
    found = sorted(tuple(r) for r in made.collect())
    text = [["", "", "", *(f"line {i} of {d} is here" for i in range(30))] for d in "ab"]
    wanted = [("x", t[k - 1], t[k], t[k - 2] or None, t[k - 3] or None) for t in text for k in range(4, 33)]
    assert found == sorted(wanted, key=lambda r: r[:3])
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"- Exchange hashpartitioning\(path#\d+, block#", plan)) == 1
