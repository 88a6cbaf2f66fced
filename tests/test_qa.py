import hashlib

from convspark.functions.split import assign_split
from convspark.operators.qa import flatten_qa, qa_examples
from convspark.schema import QA_RECORD
from convspark.sources.qa_records import parse_qa_lines, read_qa_records

# Own records: one nested record with every number of answers, copies inside and across products, holes everywhere.
RECORDS = [
    {
        "asin": "kettle",
        "questions": [
            {"questionText": "does it whistle", "answers": [{"answerText": t} for t in ("it does so", "no", "a b c d e f", "five words are just enough")]},
            {"questionText": "why", "answers": [{"answerText": "because water can boil"}]},
            {"questionText": "is there no answer", "answers": []},
        ],
    },
    {"asin": "rug-b", "question": "can I wash it", "answer": "with cold water only"},
    {"asin": "rug-b", "question": "can I wash it", "answer": "with cold water only"},
    {"asin": "rug-a", "questions": [{"questionText": "can I wash it", "answers": [{"answerText": "with cold water only"}, {"answerText": "better do not"}]}]},
    {"asin": "vase", "questions": []},
    {"asin": "shelf", "answer": "nobody has asked this"},
    {"asin": "hat", "question": "is  it wool", "answer": "mostly yes I think"},
]


def half(product):
    """Split at 0.5: the last three hex digits of the md5 of the product."""
    return "train" if (1 + int(hashlib.md5(product.encode()).hexdigest()[-3:], 16)) / 4096 < 0.5 else "test"


def tuples(records, low, high):
    """All (product, question, answer) with an accepted number of words, one record at a time."""
    out = []
    for record in records:
        pairs = [(q["questionText"], a["answerText"]) for q in record.get("questions") or [] for a in q["answers"]]
        if "question" in record:
            pairs = [(record["question"], record["answer"])]
        out += [(record["asin"], *p) for p in pairs if all(low <= t.count(" ") + 1 <= high for t in p)]
    return out


def examples(records, low, high):
    """One example per pair, with the smallest product."""
    best = {}
    for product, *pair in tuples(records, low, high):
        best[tuple(pair)] = min(product, best.get(tuple(pair), product))
    return sorted((product, *pair, half(product)) for pair, product in best.items())


EXPECTED = examples(RECORDS, 3, 5)


def test_the_case_is_not_trivial():
    assert len(EXPECTED) == 5 < len(tuples(RECORDS, 3, 5)) < len(tuples(RECORDS, 0, 99)) and {e[3] for e in EXPECTED} == {"train", "test"}


def rows(df):
    return sorted(tuple(r) for r in df.select("product_id", "context", "response", "split").collect())


def test_golden_from_literals(spark, tmp_path):
    (tmp_path / "qa.json").write_text("\n".join(map(repr, RECORDS)) + "\n")
    records = read_qa_records(spark, str(tmp_path / "*"))
    assert rows(assign_split(qa_examples(records, 3, 5), "product_id", 0.5)) == EXPECTED


def test_flatten_shapes(spark):
    both = {"asin": "9", "question": "flat", "answer": "wins",
            "questions": [{"questionText": "q", "answers": [{"answerText": "a"}]}]}
    neither = {"asin": "8"}
    df = spark.createDataFrame([both, neither, *RECORDS], QA_RECORD)
    found = sorted(tuple(r) for r in flatten_qa(df).collect())
    assert found == sorted([("9", "flat", "wins"), *tuples(RECORDS, 0, 99)])


def test_literals_that_are_not_json(spark):
    lines = [
        r"""{'asin': u'x', 'question': 'a\'b', 'answer': 'c'}""",
        """{'asin': 'y', 'question': "it's", 'answer': 'c', 'flag': True, 'none': None}""",
        r"""{'asin': 'z', 'question': 'line\nbreak \x41', 'answer': 'two ' 'parts'}""",
        """{'asin': 'w', 'question': 'plain', 'answer': 'said "so"'}""",
        "not a dict",
        "[1, 2]",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    found = sorted((r.asin or "", r.question or "", r.answer or "", r._corrupt or "") for r in parse_qa_lines(df).collect())
    assert found == sorted([
        ("x", "a'b", "c", ""),
        ("y", "it's", "c", ""),
        ("z", "line\nbreak A", "two parts", ""),
        ("w", "plain", 'said "so"', ""),
        ("", "", "", "not a dict"),
        ("", "", "", "[1, 2]"),
    ])
