"""BPE, toxicity, compression rules and perplexity on small tables with odd rows."""

import gc
import json
import math
import random
import unicodedata
import weakref
from collections import Counter

import numpy as np
import pyarrow.compute as pc
import pytest
import zstandard
from pyspark import SparkFiles
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convspark.llm import bpe, perplexity, toxicity
from convspark.llm.batches import map_rows, struct_of
from convspark.llm.lexicon import compile_words, find_words, open_packed, pack
from convspark.llm.quality_rules import CompressionRule, judge_documents
from tests.llm import brute

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, kept int, lang string"


def odd_texts():
    rnd = random.Random(7)
    texts = ["", None, " ", "the of <|endoftext|>nation  <|endoftext|>", "a  b\n\n c's don't　x՘\U00011db0z", "x" * 500, "ab" * 40_000]
    for _ in range(150):
        texts.append("".join(chr(rnd.choice([rnd.randrange(32, 127), 32, 10, rnd.randrange(0x80, 0x2000), rnd.randrange(0x10000, 0x110000)])) for _ in range(rnd.randrange(30))))
    return texts + ["the nation of the nations"] * 3


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1, "en" if i % 2 else None) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows + [(None, "null id", None, None, "en")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_transducer_finds_exactly_its_words(tmp_path):
    rnd = random.Random(1)
    words = sorted({bytes(rnd.choice(b"abc\xff") for _ in range(rnd.randrange(1, 8))) for _ in range(3000)})
    kept, others = words[::2], words[1::2]
    automaton = compile_words(kept)
    assert find_words(automaton, kept).tolist() == list(range(len(kept)))
    assert set(find_words(automaton, [*others, b"", b"zzz"]).tolist()) == {-1}
    # minimal: as many states as different sets of endings
    endings = {frozenset(w[k:] for w in kept if w.startswith(p[:k]) and len(w) >= k) for p in kept for k in range(len(p) + 1)}
    assert len(automaton["final"]) == len(endings)
    (tmp_path / "x").write_bytes(pack(automaton))
    assert all((np.asarray(v) == automaton[k]).all() for k, v in open_packed(str(tmp_path / "x")).items())
    assert find_words(compile_words([]), [b"a"]).tolist() == [-1]
    with pytest.raises(ValueError):
        compile_words([b"b", b"a"])


@pytest.mark.parametrize("max_words", [0, 3, 200_000])
def test_ids_and_texts_are_those_of_the_library(docs, max_words):
    library = tokenizers.Tokenizer.from_file(PATH)
    lexicon = bpe.build_lexicon(docs, PATH, max_words)
    encoded = bpe.encode_documents(docs, lexicon)
    assert encoded.columns == ["doc_id", "text", "kept", "lang", "ids", "n_tokens"]
    for r in bpe.decode_documents(encoded, lexicon).collect():
        wanted = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == wanted and r.n_tokens == len(wanted)
        assert r.decoded == library.decode(wanted, skip_special_tokens=False)


def test_digests(docs, nothing):
    lexicon = bpe.build_lexicon(docs, PATH)
    library = tokenizers.Tokenizer.from_file(PATH)
    for r in bpe.round_trip(docs, lexicon).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids_sha256 == __import__("hashlib").sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == brute.sha256(r.text or "")
    empty = bpe.build_lexicon(nothing, PATH)
    assert bpe.round_trip(nothing, empty).count() == 0
    assert bpe.round_trip(docs, empty).where("doc_id = 3").first().n_tokens > 0


def test_long_and_short_words_merge_alike():
    vocabulary = bpe.load_vocabulary(PATH)
    ranks = {(a, b): (k, c) for k, (a, b, c) in enumerate(vocabulary.merges.tolist())}
    library = tokenizers.Tokenizer.from_file(PATH)
    for word in ("a" * 63, "a" * 64, "a" * 200, "thethe" * 20, "ñandú" * 30):
        assert bpe.merge_word(word.encode(), vocabulary.byte_ids, ranks) == library.encode(word, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def arrays(docs):
    return open_packed(SparkFiles.get(bpe.build_lexicon(docs, PATH).name))


def test_a_worker_meets_a_word_once(arrays, monkeypatch):
    """Looking up and merging the words of every slice anew took most of the time on large tables."""
    met = []
    monkeypatch.setattr(bpe, "find_words", lambda automaton, words: met.extend(words) or find_words(automaton, words))
    coder, texts = bpe.Coder(arrays), [t or "" for t in odd_texts()]
    first = coder.encode(texts)
    assert len(met) == len(set(met)) > 100
    met.clear()
    again = coder.encode(texts[::-1] + ["the nation of new"])
    assert met == [b" new"]
    assert len(again[0]) == len(first[0]) + 4


@pytest.mark.parametrize("remembered", [0, 50, 600_000])
def test_ids_do_not_depend_on_what_is_remembered(arrays, remembered):
    library, coder = tokenizers.Tokenizer.from_file(PATH), bpe.Coder(arrays, remembered)
    texts = [t or "" for t in odd_texts()] * 2
    for k in range(0, len(texts), 7):
        ids, offsets = coder.encode(texts[k : k + 7])
        for text, a, b in zip(texts[k : k + 7], offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(coder.flat) <= remembered
    assert [len(x) for x in coder.encode([])] == [0, 1]


def test_every_character_is_split_as_the_library_does():
    library = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    known = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    # letters of the large scripts one by one would take long: all others, and every 50th of these
    known = [c for k, c in enumerate(known) if unicodedata.category(c) != "Lo" or k % 50 == 0]
    for c in known:
        text = f"a{c}b 1{c}{c}2 {c}'s {c}"
        assert bpe.split_words(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)], hex(ord(c))


def test_words_merged_together_merge_as_alone():
    vocabulary, rnd = bpe.load_vocabulary(PATH), random.Random(5)
    ranks = {(a, b): (k, c) for k, (a, b, c) in enumerate(vocabulary.merges.tolist())}
    words = ["".join(rnd.choice("thean 1\u00f1\u4e2d!") for _ in range(rnd.randrange(1, 70))).encode() for _ in range(500)]
    words += [b"a" * 63, b"a" * 64, b"\xff", b" the"]
    merger = bpe.Merger(vocabulary.merges, np.array(vocabulary.byte_ids))
    ids, offsets = merger.merge(words)
    for word, a, b in zip(words, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == bpe.merge_word(word, vocabulary.byte_ids, ranks)
    assert [len(x) for x in merger.merge([])] == [0, 1]
    # a pair that is listed twice counts with its last rank, and no merges leave the bytes
    for merges in (np.array([(0, 1, 2), (1, 1, 3), (0, 1, 4)], np.int32), np.zeros((0, 3), np.int32)):
        pairs = {(a, b): (k, c) for k, (a, b, c) in enumerate(merges.tolist())}
        ids, offsets = bpe.Merger(merges, np.array([0, 1])).merge([b"\0\1\1", b"\0\1"])
        assert ids[: offsets[1]].tolist() == bpe.merge_word(b"\0\1\1", [0, 1], pairs)
        assert ids[offsets[1] :].tolist() == bpe.merge_word(b"\0\1", [0, 1], pairs)


def test_counts_of_quality_rules(docs, nothing):
    found = judge_documents(docs).collect()
    for r in found:
        text = r.text or ""
        words = brute.WORD.findall(text)
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        inside = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(inside))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 10 or 100 * len(inside) > 20 * len(words)) and (not r.base_failed or not r.kept)
        assert (r.ratio is None) == (not text)
    assert len(found) == docs.count() and judge_documents(nothing).count() == 0


def test_bands_reject_repetition_and_noise(spark):
    rnd = random.Random(2)
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "i", "o", "u", "an", "er")]
    prose = lambda n: " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4))) for _ in range(n))
    noise = "".join(chr(rnd.randrange(0x4E00, 0x9FFF)) + " " * (k % 9 == 0) for k in range(3000))
    base64 = " ".join("".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) for _ in range(80))
    sentence = prose(60) + ". "
    half = prose(1500) + " " + (prose(3) + " ") * 1200
    cases = {"prose": (prose(400), True), "long": (prose(9000), True), "short": (prose(12), True), "noise": (noise, False), "base64": (base64, False), "same": (sentence * 30, False), "half": (half, False)}
    found = {r.name: r for r in judge_documents(spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "name string, text string")).collect()}
    assert {k: r.kept for k, r in found.items()} == {k: v for k, (_, v) in cases.items()}
    rule = CompressionRule()
    for name, (text, _) in cases.items():
        assert found[name].ratio == len(zstandard.ZstdCompressor(level=rule.level).compress(text.encode())) / len(text.encode())


def toxic_table(spark, n=1200):
    rnd = random.Random(4)
    words = [f"{a}{b}{c}" for a in "klmnp" for b in "aeiou" for c in ("ra", "to", "wen", "sil", "dor")]
    bad = ["zagr" + e for e in ("on", "ali", "ut", "ekken", "is")]
    rows = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randrange(5, 80))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(rnd.randrange(1, 4)):
                text.insert(rnd.randrange(len(text)), rnd.choice(bad) + ",")
        rows.append((i, " ".join(text).capitalize(), toxic))
    docs = spark.createDataFrame([(i, t, 0.1, "x") for i, t, _ in rows] + [(None, None, 0.2, None), (9001, "", 0.3, "y"), (9002, "Zagron " * 50_000, 0.4, "z")], "doc_id long, text string, score double, words string")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows if i % 3] + [(None, 1), (5, None), (5, 0), (5, 0)], "doc_id long, toxic int")
    return docs, labels, {i: x for i, _, x in rows}


def test_toxicity_on_held_out_texts(spark):
    docs, labels, truth = toxic_table(spark)
    model = toxicity.fit_toxicity(docs, labels)
    found = toxicity.score_toxicity(docs, model).withColumn("held", toxicity.fold(F.col("doc_id")) == 0).collect()
    assert len(found) == len(truth) + 3 and found[0].asDict().keys() == {"doc_id", "text", "words", "score", "predicted", "held"}
    held = [r for r in found if r.held and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    by = {r.doc_id: r for r in found}
    assert by[9002].predicted == 1 and by[9001].predicted == 0 and by[None].score == by[9001].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.held == (brute.crc(str(r.doc_id)) % 5 == 0) for r in found if r.doc_id is not None)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels, _ = toxic_table(spark, 300)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) toxic")
    a, b = (toxicity.fit_toxicity(docs, x) for x in (labels, turned))
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_toxicity_without_anything_to_learn(spark):
    docs, labels, _ = toxic_table(spark, 40)
    none = toxicity.fit_toxicity(docs, labels.where("toxic = 0"))
    assert all(r.score < 1e-6 for r in toxicity.score_toxicity(docs, none).collect())
    empty = toxicity.fit_toxicity(docs.limit(0), labels.limit(0))
    assert toxicity.score_toxicity(docs.limit(0), empty).count() == 0


def test_negative_risk_is_not_followed():
    # confirmed texts all have feature 0, unlabelled ones half of the time: the estimate of the clean risk would go below nought
    positive = toxicity.Sets(np.zeros(50, np.int64), np.arange(50), 50)
    unlabelled = toxicity.Sets(np.zeros(50, np.int64), np.arange(50), 100)
    weights, bias = toxicity.fit_classifier(positive, unlabelled, 0.5, 1, toxicity.ToxicityOptions())
    score = lambda x: 1 / (1 + math.exp(-x))
    assert score(weights[0] + bias) > 0.9 and score(bias) < 0.1 and np.isfinite(bias)


def plain_kneser_ney(texts):
    """Probabilities by dictionaries: {gram: p} for full grams asked for, with interpolation at every order."""
    order = perplexity.ORDER
    counts = {order: Counter(int(k) for t in texts for k in perplexity.gram_keys(t))}
    mask = lambda n: (1 << (16 * n)) - 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(k & mask(n) for k in counts[n + 1])
    cuts = {}
    for n, table in counts.items():
        of = Counter(table.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + of[2] else 0
        cuts[n] = [0]
        for k in (1, 2, 3):
            d = k - (k * y * of[k + 1] / of[k] if k > 1 else 2 * y * of[2] / of[1]) if of[k] else 0
            d = (1 - 2 * y * of[2] / of[1], 2 - 3 * y * of[3] / of[2], 3 - 4 * y * of[4] / of[3])[k - 1] if of[k] else 0
            cuts[n].append(d if 0 < d < k else k / 2)
    sums, lost = {}, {}
    for n, table in counts.items():
        for k, a in table.items():
            c = (n, k >> 16)
            sums[c] = sums.get(c, 0) + a
            lost[c] = lost.get(c, 0) + cuts[n][min(a, 3)]

    def p(key, n):
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        key &= mask(n)
        c = (n, key >> 16)
        if c not in sums:
            return p(key, n - 1)
        a = counts[n].get(key, 0)
        return (a - cuts[n][min(a, 3)]) / sums[c] + lost[c] / sums[c] * p(key, n - 1)

    return p


@pytest.mark.parametrize("broadcast", [4_000_000, 0])
def test_perplexity_agrees_with_plain_kneser_ney(spark, broadcast):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(("lorem", "ipsum", "dolor", "sit", "amet", "été")) for _ in range(rnd.randrange(1, 30))) for _ in range(80)]
    rows = [(i, t, "xx", 1.0) for i, t in enumerate(texts)] + [(100, "QZ!!#%%", "xx", 1.0), (101, None, "xx", 1.0), (102, "", None, 1.0), (103, "alone", "yy", 1.0), (104, "no language", None, 1.0), (0, texts[0], "xx", 1.0), (105, "\U0001F600\x00lorem", "xx", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity double").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(None,), (3,)], "doc_id long")
    found = perplexity.judge_perplexity(docs, trusted, perplexity.PerplexityOptions(broadcast_grams=broadcast)).collect()
    p = plain_kneser_ney([*texts[:60], texts[0]])
    assert len(found) == len(rows)
    given = {i: (t, lang) for i, t, lang, _ in rows}
    for r in found:
        text, lang = given[r.doc_id]
        assert r.lang == lang and r.n_chars == len(text or "") and r.trusted == (r.doc_id < 60)
        if not text or lang != "xx":
            assert r.perplexity is None and r.kept
        else:
            keys = [int(k) & ((1 << 64) - 1) for k in perplexity.gram_keys(text)]
            wanted = math.exp(-sum(math.log(p(k, perplexity.ORDER)) for k in keys) / len(keys))
            assert r.perplexity == pytest.approx(wanted, rel=1e-4)
    assert not next(r for r in found if r.doc_id == 100).kept and all(r.kept for r in found if r.trusted)
    assert perplexity.judge_perplexity(docs.limit(0), trusted).count() == 0


def test_vocabulary_file_is_read():
    content = json.load(open(PATH, encoding="utf-8"))
    vocabulary = bpe.load_vocabulary(PATH)
    assert len(vocabulary.merges) == len(content["model"]["merges"]) and vocabulary.special == {"<|endoftext|>": 50256}


def test_a_worker_keeps_the_coder_of_one_lexicon(monkeypatch):
    """Workers live on between jobs: with the coders of earlier lexicons an executor's memory ran out."""
    monkeypatch.setattr(bpe, "SparkFiles", type("Files", (), {"get": staticmethod(lambda name: name)}))
    monkeypatch.setattr(bpe, "open_packed", lambda path: path)
    monkeypatch.setattr(bpe, "Coder", type("Coder", (), {"__init__": lambda self, arrays: None}))
    bpe._coder.cache_clear()
    first = weakref.ref(bpe._coder("one"))
    assert bpe._coder("one") is first()
    bpe._coder("two")
    gc.collect()
    assert first() is None
    bpe._coder.cache_clear()


def test_the_text_crosses_to_python_once(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None), (3, "")], "id long, text string")

    def work(values):
        return [pc.fill_null(pc.utf8_length(values), -1).cast("int64")]

    for keep in (True, False):
        found = map_rows(docs, "text", struct_of(n=T.LongType()), work, keep_input=keep)
        assert sorted(tuple(r) for r in found.collect()) == [(1, *["ab"] * keep, 2), (2, *[None] * keep, -1), (3, *[""] * keep, 0)]
        sent = found._jdf.queryExecution().analyzed().toString().split("MapInArrow")[1].split("Project [")[1].split("]")[0]
        assert sent.count("text#") == 1
    replaced = map_rows(docs, "text", struct_of(text=T.LongType()), work)
    assert sorted(tuple(r) for r in replaced.collect()) == [(1, 2), (2, -1), (3, 0)]
