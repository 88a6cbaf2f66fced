"""The pipeline's stages, one by one, against brute force on the smallest tables with odd rows added."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from convspark.llm import queries
from convspark.llm.toxicity import fit_toxicity, score_toxicity
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")

#: What every contract asks for.
COLUMNS = {
    "op1_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_hash_tree": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3_licences": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op4_perplexity": "doc_id bigint, perplexity double, kept boolean",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op7_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op8_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op10_multi_index": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_give_every_row_and_column(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    types = dict(found.dtypes)
    assert all(types[c] == t for c, t in (x.rsplit(" ", 1) for x in COLUMNS[name].split(", ")))
    table = "embeddings" if name.startswith("op10") else "documents"
    assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("score", F.lit("own")).withColumn("copies", F.lit(9))
    odd = spark.createDataFrame(
        [(9001, None, "en", "src1", None), (9002, "", None, None, 0), (9002, "", None, None, 0), (None, "a null id", "en", "src2", 9), (9003, "word " * 30_000, "en", "src1", 150_000)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return given.unionByName(odd, allowMissingColumns=True).cache()


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, docs):
    kept = pipeline.toxicity(spark, docs, SF_DIR)
    model = fit_toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scored = score_toxicity(docs.select("doc_id", "text"), model).collect()
    assert kept.columns == docs.columns
    assert Counter(texts(kept)) == Counter((r.doc_id, r.text) for r in scored if r.predicted == 0)
    assert 0 < kept.count() < docs.count()

    lines = pipeline.line_dedup(spark, docs, SF_DIR).cache()
    wanted = Counter((r[0], r[3]) for r in brute.line_dedup(texts(docs)))
    assert lines.columns == docs.columns and Counter((d, brute.sha256(t)) for d, t in texts(lines)) == wanted
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    named = lines.where("doc_id IS NOT NULL AND doc_id <> 9002")
    single = pipeline.near_copies(spark, lines, SF_DIR)
    groups = brute.jaccard_components(texts(named), 5, 80)
    alone = [d for d, (n, c) in groups.items() if d == c]
    assert single.columns == docs.columns and sorted(d for d, _ in texts(single.where("doc_id < 9002 OR doc_id > 9002"))) == sorted(alone)
    assert single.where("doc_id = 9002 OR doc_id IS NULL").count() == 3

    mix = pipeline.mixing(spark, docs, SF_DIR).cache()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(brute.WORD.findall(r.text or ""))
    taken = Counter()
    for r in mix.collect():
        taken[r.source] += len(brute.WORD.findall(r.text or ""))
    goal = brute.targets(sizes)
    assert mix.columns == docs.columns and max(Counter(texts(mix.where("doc_id <> 9002"))).values()) <= 2
    assert all(taken[s] <= goal[s] + 1e-6 for s in goal) and sum(taken.values()) > 0.9 * sum(goal.values())

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(pipeline.VOCABULARY)
    encoded = pipeline.encoding(spark, docs, SF_DIR).collect()
    own = Counter((d, tuple(library.encode(t or "", add_special_tokens=False).ids)) for d, t in texts(docs))
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded) == own


def test_the_whole_pipeline(spark):
    found = pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and found.count() > 0
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources", "BPE encoding"]


def test_stages_on_empty_tables(spark, docs):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
