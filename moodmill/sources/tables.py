"""Parquet tables and the labelled views built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SENTIMENT_CLASSES = ("negative", "neutral", "positive")


#: Session setting: the number of partitions that wide tables are dealt to after the scan. For inputs
#: stored as a few large splits, which cannot keep a session's cores busy; unset, nothing is moved.
SPREAD = "spark.moodmill.spreadInputs"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    partitions = spark.conf.get(SPREAD, None)
    return table.repartition(int(partitions)) if partitions else table


def sentiment_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "negative").when(quality == 1, "positive").otherwise("neutral")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text, sentiment`` for every document that carries a label."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", sentiment_of(F.col("quality"), F.col("toxic")).alias("sentiment")
    )
    return documents.join(labels, "doc_id")


def labelled_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text, role`` with one row per turn; the key joins both id columns."""
    turns = read_table(spark, sf_dir, "conversations")
    return turns.select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text", "role")
