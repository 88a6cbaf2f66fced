"""Columns whose names an operator uses itself, or that need quotes, in every operator and pipeline stage."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from convspark.llm.bpe import build_lexicon, decode_documents, encode_documents, round_trip
from convspark.llm.hash_tree import Topology, shard_documents
from convspark.llm.jaccard_join import drop_near_copies, jaccard_components
from convspark.llm.licences import scan_licences
from convspark.llm.line_dedup import drop_repeated_lines
from convspark.llm.mixing import mix_sources, mixed_documents
from convspark.llm.multi_index import near_vectors
from convspark.llm.packing import pack_documents
from convspark.llm.perplexity import judge_perplexity
from convspark.llm.quality_rules import judge_by_trusted, judge_documents
from convspark.llm.resampling import resample
from convspark.llm.spelling import spelling_variants
from convspark.llm.toxicity import fit_toxicity, score_toxicity

#: Names of operators' own columns, names that need quotes, and names that a struct could have.
NAMES = (
    "_own _lines _doc _text _words _input _id _row _pos _dropped _keeper _at0 _every _base _met _best _label _u _good _half id row is_row "
    "node root cluster n key word code a b bucket ordinal rank_ falling _file a.b x/y"
).split()


def rows():
    rnd = random.Random(1)
    words = "the mit license apache version 2 under some more words of prose here".split()
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 4, 30, 60]))) for _ in range(60)]
    line = "a line of more than forty characters that many documents share"
    return [(i, f"{t}\n{line}" if i % 3 == 0 else t, f"s{i % 3}") for i, t in enumerate([*texts, texts[3], None, ""])]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(rows(), "doc_id long, text string, source string").withColumn("lang", F.lit("en"))
    return plain.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in NAMES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 4 == 0) for i in range(60)], "doc_id long, quality int, toxic boolean").withColumn(
        "toxic", F.col("toxic").cast("int")
    )


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def encoded(docs, labels):
    lexicon = build_lexicon(docs, VOCABULARY)
    return decode_documents(encode_documents(docs, lexicon), lexicon)


#: Operators that keep the columns of their input, and those that only take what they need from it.
KEEPING = {
    "encode": encoded,
    "round trip": lambda d, labels: round_trip(d, build_lexicon(d, VOCABULARY)),
    "licences": lambda d, labels: scan_licences(d),
    "toxicity": lambda d, labels: score_toxicity(d, fit_toxicity(d, labels)),
    "lines": lambda d, labels: drop_repeated_lines(d),
    "near copies": lambda d, labels: drop_near_copies(d, 3, 80),
    "mixed": lambda d, labels: mixed_documents(d),
    "quality": lambda d, labels: judge_documents(d),
}
TAKING = {
    "shards": lambda d, labels: shard_documents(d, Topology.uniform(2, 2, 4)),
    "perplexity": lambda d, labels: judge_perplexity(d, labels.where("quality = 1")),
    "jaccard": lambda d, labels: jaccard_components(d),
    "mix": lambda d, labels: mix_sources(d),
    "trusted": lambda d, labels: judge_by_trusted(d, labels.where("quality = 1")),
    "resampling": lambda d, labels: resample(d, d.where("doc_id < 5")),
    "spelling": lambda d, labels: spelling_variants(d),
    "packing": lambda d, labels: pack_documents(d, public_tokenizers.path("word_bpe_49k.json")),
}


@pytest.mark.parametrize("name", KEEPING)
def test_columns_come_through(docs, labels, name):
    found = KEEPING[name](docs, labels)
    assert found.columns[: len(docs.columns)] == docs.columns or set(docs.columns) <= set(found.columns)
    kept = found.select("doc_id", *[F.col("`" + n.replace("`", "``") + "`") for n in NAMES]).collect()
    assert kept and all(list(r[1:]) == [f"{n}-{r.doc_id}" for n in NAMES] for r in kept)


@pytest.mark.parametrize("name", TAKING)
def test_columns_do_no_harm(docs, labels, name):
    plain = TAKING[name](docs.select("doc_id", "text", "source", "lang"), labels)
    found = TAKING[name](docs, labels)
    assert found.columns == plain.columns and not set(found.columns) & {"_own", "a.b"}
    assert found.count() == plain.count() > 0


def test_vectors(spark):
    table = spark.createDataFrame([(i, [1.0, float(i % 3)], "l") for i in range(30)], "vec_id long, embedding array<double>, label string")
    many = table.select("*", *[F.lit(n).alias(n) for n in NAMES])
    assert sorted(near_vectors(many).collect()) == sorted(near_vectors(table).collect())


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, labels, stage, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    function = dict(corpus_pipeline.STAGES)[stage]
    found = function(spark, docs, str(tmp_path))
    last = stage == corpus_pipeline.STAGES[-1][0]
    assert found.count() > 0 and (last or found.columns == docs.columns)
    if not last:
        kept = found.select("doc_id", "_own", "`a.b`").collect()
        assert all(tuple(r) == (r.doc_id, f"_own-{r.doc_id}", f"a.b-{r.doc_id}") for r in kept)
