import random

from pyspark.sql import functions as F

from convspark.functions import text
from convspark.functions.split import split_label, split_value


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select(expression.alias("x"), "i").orderBy("i").select("x").collect()]


def longest_cut(value, limit):
    """Brute force: the longest prefix, at most ``limit`` long, that ends where a word starts or ends."""
    if len(value) <= limit:
        return value
    cuts = [n for n in range(1, limit + 1) if value[n - 1].isalnum() != value[n].isalnum()]
    return value[: max(cuts, default=0)]


def test_trim_against_brute_force(spark):
    rng = random.Random(5)
    alphabet = "aZ9_ é.\n中-\t½ß"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    for limit in (1, 7, 16):
        assert column(spark, values, text.trim("t", limit)) == [longest_cut(v, limit) for v in values]


def test_ids_lose_their_type_prefix(spark):
    raw = ["t3_q7", "t9_", "plain", "tt1_x", "t1_t2_x", "t12_x", "T1_x"]
    assert column(spark, raw, text.normalise_id("t")) == ["q7", "", "plain", "tt1_x", "t2_x", "t12_x", "T1_x"]


def cleaned(line):
    """Brute force: speakers, then bracketed remarks, then edges, found character by character."""
    word = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
    out, i = "", 0
    while i < len(line):
        # where a name may start: at the start, or behind a sentence end and a blank, which go with it
        for start in [i] * (i == 0) + [i + 2] * (line[i] in ".!?" and line[i + 1 : i + 2] in set(" \t\n\x0b\f\r")):
            end = start
            while end < len(line) and line[end] in word:
                end += 1
            if start < end < len(line) and line[end] == ":":
                i = end + 1
                break
        else:
            out += line[i]
            i += 1
    spoken, out, i = out, "", 0
    while i < len(spoken):
        end = i + 1
        while spoken[i] in "[(" and end < len(spoken) and spoken[end] not in "])\n":
            end += 1
        if spoken[i] in "[(" and end < len(spoken) and spoken[end] in "])":
            i = end + 1
        else:
            out += spoken[i]
            i += 1
    return out.strip(" -\n")


def test_preprocess_line_against_brute_force(spark):
    rng = random.Random(8)
    parts = ["anna", "R2_", "é", ":", ": ", " ", ".", "! ", "?\t", "[", "]", "(", ")", "-", "\n", "so", "\r"]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    assert column(spark, lines, text.preprocess_line("t")) == [cleaned(line) for line in lines]


def test_word_count_counts_empty_pieces(spark):
    assert column(spark, ["", "a  b ", "one", "a b c"], text.word_count("t")) == [1, 4, 1, 3]


def test_tokens(spark):
    assert column(spark, ["Hello, a WORLD_1 é éa!", ""], text.tokens("t")) == [["hello", "world_1", "éa"], []]


def test_split_values(spark):
    # Splits that the published sets have.
    keys = ["thread-A", "testthread", "input_train.txt", "input_test.txt", "1", "2", "3", "4"]
    expected = [0.0849609375, 0.78271484375, 0.499755859375, 0.517333984375,
                0.2880859375, 0.385986328125, 0.6845703125, 0.135986328125]
    assert column(spark, keys, split_value("t")) == expected
    assert column(spark, keys, split_label("t", 0.5)) == [
        "train", "test", "train", "test", "train", "train", "test", "train"
    ]


def test_split_value_lies_above_zero_and_can_be_one(spark):
    df = spark.range(20000).select(split_value(F.col("id").cast("string")).alias("v"))
    low, high = df.agg(F.min("v"), F.max("v")).first()
    assert low == 1 / 4096 and high == 1.0
