"""The queries of this subpackage by name, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmill.llm import conversation_repair, hard_negatives, hnsw, language_id, mixing, packing, personal_data, quality_rules, secret_scan, simhash_dedup, substring_dedup, token_file, toxicity
from moodmill.llm.oracle import ORACLE
from moodmill.llm.text import word_count
from moodmill.llm.workers import let_workers_import
from moodmill.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    fingerprint = simhash_dedup.hexadecimal(F.col("fp")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


@query
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_file.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", "source", "lang")
    return secret_scan.report(docs, F.col("source"), repository)


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.measure(docs, "doc_id").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    mixed = mixing.sequence_by_position(mixing.mix(docs, word_count(F.col("text"))), "doc_id")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hnsw.valid_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hnsw.nearest(rows.filter("id % 100 = 0"), hnsw.index(rows))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


@query
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(read_table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.valid_rows(vectors, "vec_id", "embedding", label)
    return hard_negatives.mine(rows, rows.filter("id % 100 = 0"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversations, conversation_repair.damaged(conversations))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLE", "QUERIES"]
