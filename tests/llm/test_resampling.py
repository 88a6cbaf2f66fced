"""Importance resampling against a plain restatement, the open-addressed table, and odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from convspark.llm.byte_runs import ByteRuns
from convspark.llm.resampling import Features, intern, resample
from tests.llm import brute


def features(text, width=3):
    words = brute.LICENCE_WORD.findall(brute.lower(text))
    return words, [" ".join(words[i : i + k]) for k in range(1, width + 1) for i in range(len(words) - k + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def expected(docs, target, percent=5, width=3, buckets=10_000, min_words=20):
    """[(id, n_features, weight, score, rank)]; ranks by the order of the contract, a null id first."""
    raw, good = (Counter(bucket(f, buckets) for t in texts for f in features(t, width)[1]) for texts in ([t for _, t in docs], target))
    s_all, t_all = sum(raw.values()), sum(good.values())

    def gain(b):
        return math.floor(1000 * math.log((good[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets))))

    scored, able = [], []
    for key, text in docs:
        words, found = features(text, width)
        weight = sum(gain(bucket(f, buckets)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([key, len(found), weight, score, None])
        if len(words) >= min_words:
            able.append(scored[-1])
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted(map(tuple, scored), key=str)


def rows():
    rnd = random.Random(9)
    words = "alpha Beta gamma DELTA été 李明 x1 of the and in".split() + [f"w{k}" for k in range(60)]
    out = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 5, 20, 21, 80])))) for i in range(300)]
    return out + [(300, None), (301, ""), (None, "alpha beta " * 30), (302, "of the " * 30_000), (303, "y" * 300 + "." + "y" * 300), out[7], out[7]]


TARGET = ["alpha beta gamma in the été", "w1 w2 w3 w4 of 李明", None, ""]


@pytest.mark.parametrize("percent, width, buckets", [(5, 3, 10_000), (40, 2, 7), (100, 1, 64), (0, 3, 100)])
def test_weights_scores_and_ranks(spark, percent, width, buckets):
    docs = spark.createDataFrame([(*r, "o", 1) for r in rows()], "doc_id long, text string, score string, id int").repartition(5)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    found = resample(docs, target, percent, width, buckets)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    mine = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=str)
    wanted = expected(rows(), TARGET, percent, width, buckets)
    # rows that repeat an id and a text may swap ranks
    assert Counter(r[:4] for r in mine) == Counter(r[:4] for r in wanted)
    assert sorted((r[4], r[0], r[3]) for r in mine if r[4]) == sorted((r[4], r[0], r[3]) for r in wanted if r[4])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    assert resample(docs, target).collect() == []
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    [row] = resample(one, target, percent=100).collect()
    assert row["rank"] == 1 and row.n_words == 40


def test_runs_of_bytes_have_the_checksums_of_the_libraries():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8).tobytes()
    starts = rng.integers(0, 4000, 3000)
    ends = starts + rng.integers(0, 400, 3000)
    parts = ByteRuns(data, starts, ends)
    assert parts.xxh64().tolist() == [xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    assert parts.crc32(np.arange(3000)).tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends, strict=True)]


def test_equality_looks_at_every_byte():
    data = b"abcdefgh1|abcdefgh2|abcdefgh1|" + b"z" * 299 + b"1" + b"z" * 299 + b"2"
    parts = ByteRuns(data, np.array([0, 10, 20, 30, 330, 0]), np.array([9, 19, 29, 330, 630, 0]))
    assert parts.equal(np.array([0, 0, 3, 5]), np.array([2, 1, 4, 5])).tolist() == [True, False, False, True]


def test_equal_keys_of_different_bytes_get_slots_of_their_own(monkeypatch):
    monkeypatch.setattr(ByteRuns, "xxh64", lambda self: np.full(len(self.starts), 15, np.uint64))
    words = [b"aa", b"ab", b"aa", b"ba", b"ab", b"aa"]
    ends = np.cumsum([len(w) for w in words])
    slots, owner = intern(ByteRuns(b"".join(words), ends - 2, ends))
    assert len(set(slots.tolist())) == 3 and slots[0] == slots[2] == slots[5] and slots[1] == slots[4]
    assert {bytes(words[owner[s]]) for s in slots} == {b"aa", b"ab", b"ba"}


def test_features_of_slices_without_words():
    found = Features(pa.array(["", None, "--"]), 3, 10)
    assert found.words.tolist() == [0, 0, 0] and len(found.slots) == 0
