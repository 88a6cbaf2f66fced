"""Spelling variants against all pairs compared, and odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from convspark.llm import spelling
from convspark.llm.spelling import choose_symbols, follow, near_pairs, neighbour_keys, spelling_variants
from tests.llm import brute

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs, min_count=3):
    counts = Counter()
    for key, text in docs:
        for run in RUN.findall(text or ""):
            word = brute.lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= min_count}
    around = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for word, others in around.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    result = []
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        result.append((word, form[word], root, n[word], len(around[word]), n.get(form[word])))
    return sorted(result, key=str)


def rows():
    rnd = random.Random(6)
    stems = ["colour", "color", "colouring", "Grüße", "gruesse", "étudiant", "etudiant", "naïve", "aaaaaa", "ababab", "spelling", "þorn÷x"]
    words = []
    for stem in stems:
        words += [stem] * 40
        for _ in range(25):
            at, letter = rnd.randrange(len(stem)), rnd.choice("abceéÿoxz")
            new = rnd.choice([stem[:at] + stem[at + 1 :], stem[:at] + letter + stem[at:], stem[:at] + letter + stem[at + 1 :]])
            words += [new] * rnd.choice([1, 3, 6, 14, 15])
    out = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([3, 30, 90])))) for i in range(160)]
    return out + [(160, None), (161, ""), (None, "Spelling, spellnig; SPELLING"), out[2], out[2], (162, "colour " * 20_000), (163, "abcde" * 2000 + " ")]


def result(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_words_forms_and_roots(spark):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows()], "doc_id long, text string, word int, n string, form string")
    assert result(spelling_variants(docs.repartition(4))) == expected(rows())


def test_very_long_words(spark):
    long = "lorem" * 500
    docs = [(i, f"{long} {long[:1200]}{long[1201:]} {long[:7]}q{long[8:]}") for i in range(3)]
    found = spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"), drop_one_in=0)
    assert {r.n_near for r in found.collect()} == {1, 2} or {r.n_near for r in found.collect()} == {1}
    assert sum(r.n_near for r in found.collect()) == sum(near(a, b) for a in docs[0][1].split() for b in docs[0][1].split())


@pytest.mark.parametrize("symbols", [1, 4, 24])
def test_the_alphabet_changes_no_pair(spark, symbols):
    rnd = random.Random(symbols)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randrange(5, 9))) for _ in range(400)})
    table = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, n long")
    found = sorted((r.a, r.b) if r.a < r.b else (r.b, r.a) for r in near_pairs(table, symbols, 3).collect())
    assert found == [(a, b) for a in words for b in words if a < b and near(a, b)]


def test_words_of_one_key_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_BASE", np.uint64(1))  # keys are sums of digits
    words = ["abcde", "abcdf", "edcba", "abcdef", "zzzzz", "zzzz"]
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    keys = {w: k for w, k in zip(words, spelling.code_keys(pa.array(["01234", "01233", "43210", "012345", "55555", "5555"]), 24).tolist(), strict=True)}
    assert keys["abcde"] == keys["edcba"]
    assert neighbour_keys(np.array([[1, 2]], np.uint64), 2).tolist() == [sorted([3, 2, 1, 3, 4, 2, 3, 4, 5, 4, 5, 4, 5])]
    assert near_pairs(table, 4, 2).count() >= 0


def test_chains_are_followed_to_their_ends(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"x{i}", "w30") for i in range(20)]
    found = follow(spark.createDataFrame(links, "word string, form string"))
    assert {r.root for r in found.collect()} == {"w37"} and found.count() == 57
    assert follow(spark.createDataFrame([], "word string, form string")).count() == 0


def test_work_estimate_grows_the_alphabet():
    few, many = ({length: n for length in range(5, 12)} for n in (100, 10_000_000))
    assert choose_symbols(few)[0] < choose_symbols(many)[0] and choose_symbols({})[1] == 0


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(nothing).collect() == []
    blank = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert spelling_variants(blank.withColumn("x", F.lit(1))).collect() == []


def test_neighbourhoods_are_not_broadcast(spark, monkeypatch):
    """Spark takes them for as small as the words they are made of: a broadcast of them filled the driver."""
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randrange(5, 9))) for _ in range(300)})
    table = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "word string, n long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        for most in (200_000, 0):
            monkeypatch.setattr(spelling, "BROADCAST_ROWS", most, raising=False)
            pairs = near_pairs(table, 8, 3)
            assert pairs.count() == sum(near(a, b) for a in words for b in words if a < b)
            sides = pairs._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")
            # what stands below a broadcast, up to the next line that is no deeper
            for above, side in zip(sides, sides[1:], strict=False):
                depth = len(above.rpartition("\n")[2])
                below = side.split("\n")[1:]
                end = next((k for k, x in enumerate(below) if len(x) - len(x.lstrip(" :|+-")) <= depth), len(below))
                assert "MapInArrow" not in "\n".join(below[:end])
            assert len(sides) == (1 if not most else 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
