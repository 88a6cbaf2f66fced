"""Bands of the compression ratio that are taken from trusted texts."""

import random

import zstandard

from convspark.llm import quality_rules
from convspark.llm.quality_rules import Band, CompressionRule, fit_bands, judge_by_trusted, judge_documents

HEX, LETTERS, DIGITS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "0123456789"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def noise(rnd, letters, size):
    return " ".join("".join(rnd.choice(letters) for _ in range(8)) for _ in range(size // 9 + 1))[:size]


def test_noise_is_told_from_prose_by_fitted_bands(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice(("ba", "ten", "or", "si", "mu", "lan", "dre", "o", "th")) for _ in range(rnd.randrange(1, 4))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    trusted = spark.createDataFrame([(prose(int(2 ** rnd.uniform(5, 12.7))),) for _ in range(2500)] + [(None,), ("",)], "text string")
    cases = {("prose", n): prose(n) for n in (70, 260, 1510, 6020)}
    cases |= {(name, size): noise(rnd, letters, size) for name, letters in (("hex", HEX), ("letters", LETTERS), ("digits", DIGITS), ("base64", BASE64)) for size in (1800, 9000, 30_000)}
    cases["tail", 0] = prose(9000)[:49_152] + noise(rnd, BASE64, 16_384)
    docs = spark.createDataFrame([(f"{a}-{b}", t) for (a, b), t in cases.items()], "name string, text string")
    found = {r.name: r.kept for r in judge_documents(docs, fit_bands(trusted)).collect()}
    assert found == {f"{a}-{b}": a == "prose" for a, b in cases}


def verdict(data, rule):
    """Plain restatement of what is outside: whole texts, chunks, kept."""

    def outside(part, bands):
        ratio = len(zstandard.ZstdCompressor(level=rule.level).compress(part)) / len(part)
        band = max((b for b in bands if b.min_bytes <= len(part)), key=lambda b: b.min_bytes, default=Band(0, None, None))
        return (band.low is not None and ratio < band.low) or (band.high is not None and ratio > band.high)

    chunks = [data[a : a + rule.chunk_bytes] for a in range(0, len(data), rule.chunk_bytes)]
    bad = sum(outside(c, rule.chunk_bands) for c in chunks)
    return len(chunks), bad, not data or not (outside(data, rule.document_bands) or bad > rule.max_bad_share * len(chunks))


def some_texts(rnd):
    words = ["".join(rnd.choice(("ba", "ten", "or", "si", "mu", "lan")) for _ in range(rnd.randrange(1, 4))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    out = [prose(int(2 ** rnd.uniform(4, 12))) for _ in range(60)]
    out += [noise(rnd, x, int(2 ** rnd.uniform(5, 15))) for x in (HEX, LETTERS, DIGITS, BASE64) for _ in range(8)]
    return out + [prose(900) + noise(rnd, BASE64, 6000), "word " * 5000, "", "ab" * 2048, "x" * 4096, None]


def test_verdicts_against_brute_force(spark):
    rnd = random.Random(12)
    texts = some_texts(rnd)
    rules = [CompressionRule(), CompressionRule(chunk_bytes=512, max_bad_share=0.3, chunk_bands=(Band(100, 0.3, 0.7), Band(512, None, 0.6)))]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    for rule in rules:
        for r in judge_documents(docs, rule).collect():
            chunks, bad, fine = verdict((texts[r.n] or "").encode(), rule)
            assert (r.n_chunks, r.n_bad_chunks, r.kept) == (chunks, bad, fine and not r.base_failed)


def test_each_text_is_judged_by_the_other_half(spark):
    many = [t for seed in range(12) for t in some_texts(random.Random(seed))]
    texts = list(enumerate(many)) + [(None, "a few words more than ten of them are here, I think")]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in texts], "doc_id long, text string, ratio string, n_bytes int, `a.b` int")
    ids = [i for i, t in texts if i is not None and i % 3]
    trusted = spark.createDataFrame([(i,) for i in ids + ids[:9] + [None]], "doc_id long")
    found = {r.doc_id: r for r in judge_by_trusted(docs.repartition(3), trusted).collect()}
    half = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 2) h").collect()}
    by_half = {h: spark.createDataFrame([(t,) for i, t in texts if i in set(ids) and half[i] == h], "text string") for h in (0, 1)}
    rules = {0: fit_bands(by_half[1]), 1: fit_bands(by_half[0])}
    assert rules[0] != rules[1] and len(found) == len(texts)
    for i, text in texts:
        chunks, bad, fine = verdict((text or "").encode(), rules[half[i] if i is not None else 0])
        assert (found[i].n_chunks, found[i].n_bad_chunks, found[i].kept) == (chunks, bad, fine and not found[i].base_failed), i
    assert judge_by_trusted(docs.limit(0), trusted).collect() == [] and judge_by_trusted(docs, trusted.limit(0)).count() == len(texts)


def test_no_text_moves(spark, monkeypatch):
    """Whatever the sizes, the labels meet measures, not texts."""
    plans = []
    whole = quality_rules.materialise
    monkeypatch.setattr(
        quality_rules, "materialise", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), whole(df, label))[1]
    )
    docs = spark.createDataFrame(list(enumerate(some_texts(random.Random(1)))), "doc_id long, text string")
    judged = judge_by_trusted(docs, docs.select("doc_id"))
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert "text" not in judged.columns and "Exchange" not in judged._jdf.queryExecution().executedPlan().toString()


def test_without_trusted_texts_the_rule_stays(spark):
    assert fit_bands(spark.createDataFrame([], "text string")) == CompressionRule()
    assert fit_bands(spark.createDataFrame([(None,), ("few words",)], "text string")) == CompressionRule()
