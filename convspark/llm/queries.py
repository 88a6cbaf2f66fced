"""The operators as queries over the whole tables: name -> function, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.llm import sql
from convspark.llm.bpe import build_lexicon, round_trip
from convspark.llm.hash_tree import Topology, shard_documents
from convspark.llm.jaccard_join import jaccard_components
from convspark.llm.licences import scan_licences
from convspark.llm.line_dedup import drop_repeated_lines
from convspark.llm.mixing import mix_sources
from convspark.llm.multi_index import near_vectors
from convspark.llm.packing import pack_documents
from convspark.llm.perplexity import judge_perplexity
from convspark.llm.quality_rules import judge_by_trusted
from convspark.llm.resampling import resample
from convspark.llm.spelling import spelling_variants
from convspark.llm.toxicity import fit_toxicity, fold, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(statement: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if statement is not None:
            SQL[function.__name__] = statement
        return function

    return add


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


#: Vocabulary of the BPE query.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return round_trip(docs, build_lexicon(docs, VOCABULARY)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir, "doc_id", "text"), Topology.uniform(2, 2, 4))


@query(sql.LICENCES)
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query()
def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_perplexity(documents(spark, sf_dir, "doc_id", "text", "lang"), labels.where("quality = 1"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


@query(sql.LINE_DEDUP)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, sf_dir, "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query()
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(documents(spark, sf_dir, "doc_id", "text"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query(sql.MIXING)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    judged = judge_by_trusted(docs, trusted)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "ratio", "n_chunks", "n_bad_chunks",
    )


@query()
def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")


@query(sql.RESAMPLING)
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    drawn = resample(documents(spark, sf_dir, "doc_id", "text"), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(sql.SPELLING)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir, "doc_id", "text"))


#: Vocabulary of the packing query.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@query()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(documents(spark, sf_dir, "doc_id", "text"), WORD_VOCABULARY)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
