"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, packing.

Each stage reads what its predecessor has written. All but the last return the columns of
``documents``; the last returns the pieces of packed sequences.

1. ``quality_rules`` drops the documents that the rules reject.
2. ``near_duplicates`` keeps one document of each group linked by SimHash fingerprints: four-word shingles, four bits.
3. ``secrets`` replaces the secrets of one owner or a few in the texts; all documents stay.
4. ``mix_sources`` repeats or leaves out documents to meet the sources' targets, in training order.
5. ``pack`` cuts and packs the token ids into sequences.

Defined results, stage by stage: documents with a null or an empty text, or with few words, go in the first stage; rows
that share a key (null included) are documents of their own, and of rows equal in key and text one stays; a null source
is a source of its own; very long texts are read, mixed and packed whole; ties go to the smaller key; an
empty table gives an empty table. Extra columns of the documents, whatever their names, pass through all stages but the
last, which returns the columns of packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodmill.llm import mixing, packing, quality_rules, secret_scan, simhash_dedup
from moodmill.llm.text import word_count
from moodmill.llm.workers import let_workers_import
from moodmill.storage import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return simhash_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = secret_scan.redact(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.curriculum(docs, word_count(F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Near-duplicates and column generation are not expressible in SQL; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` of a folder; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
