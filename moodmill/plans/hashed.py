"""Token cleaning, 25,000 hash buckets, plain TF-IDF and smoothed Naive Bayes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tokens import clean_tokens
from ..operators import crossval, naive_bayes, prepare, splits
from ..operators.features import NUM_FEATURES, bucket_vector, unfold
from ..sources import SENTIMENT_CLASSES, labelled_documents
from ..storage import materialise

CV_FOLDS = 2


def allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, sentiment, text`` of the allowed labels, copies included."""
    rows = prepare.keep_labels(labelled_documents(spark, sf_dir), "sentiment", SENTIMENT_CLASSES)
    return prepare.drop_nulls(rows, "text")


def _labelled(rows: DataFrame, *keep: str) -> DataFrame:
    coded = prepare.encode_label(rows, "sentiment").select("doc_id", "label", *keep)
    return splits.train_test(coded)


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, split`` of one document per text and label; only digests and keys travel."""
    rows = allowed(spark, sf_dir)
    marked = rows.select("doc_id", "sentiment", prepare.digest(rows, "text").alias("digest"))
    return _labelled(marked.groupBy("sentiment", "digest").agg(F.min("doc_id").alias("doc_id")))


def features(spark: SparkSession, sf_dir: str, value: Column, name: str) -> DataFrame:
    """``doc_id, label, split`` and ``value`` of each text, copies merged.

    ``value`` is computed in the one pass over the texts and stored; copies are then left out of the
    stored table, so a text is read once and moved nowhere.
    """
    rows = allowed(spark, sf_dir)
    marks = [prepare.digest(rows, c).alias(f"_group_{i}") for i, c in enumerate(("sentiment", "text"))]
    stored = materialise(rows.select("doc_id", "sentiment", *marks, value.alias(name)), f"document-{name}")
    first = stored.groupBy("_group_0", "_group_1").agg(F.min("doc_id").alias("doc_id"))
    return _labelled(prepare.keep_least(stored, materialise(first, "survivors")), name)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, split, vector`` with the counted buckets of each document, from a stored table."""
    return features(spark, sf_dir, bucket_vector(clean_tokens(F.col("text"))), "vector")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, split, words``: the cleaned words of each document, from a stored table."""
    return features(spark, sf_dir, clean_tokens(F.col("text")), "words")


def replicated_vectors(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    """Every labelled document ``times`` times under keys of their own, copies kept.

    A text is cleaned and counted once, and its vector stored once; the rows are repeated where they are read.
    """
    rows = prepare.keep_labels(labelled_documents(spark, sf_dir), "sentiment", SENTIMENT_CLASSES)
    rows = prepare.encode_label(prepare.drop_nulls(rows, "text", "sentiment"), "sentiment")
    vector = bucket_vector(clean_tokens(F.col("text"))).alias("vector")
    stored = materialise(rows.select("doc_id", "label", vector), "single-vectors")
    copies = prepare.replicate(stored, times)
    keyed = copies.withColumn("doc_id", F.concat_ws("-", "doc_id", "copy")).drop("copy")
    return splits.train_test(keyed)


def entries(docs: DataFrame, *keep: str) -> DataFrame:
    return unfold(docs, F.col("vector"), ["doc_id", *keep])


def counts(docs: DataFrame) -> naive_bayes.Counts:
    return naive_bayes.count_training(entries(docs, "label", "split"))


def fitted(docs: DataFrame) -> naive_bayes.Model:
    return naive_bayes.fit_plain_tfidf(counts(docs), NUM_FEATURES)


def predictions(docs: DataFrame) -> DataFrame:
    """Every document, training and test, scored by the model of the training part."""
    return naive_bayes.predict(fitted(docs), entries(docs, "label", "split"))


def test_predictions(docs: DataFrame) -> DataFrame:
    test = docs.filter(F.col("split") == "test")
    return naive_bayes.predict(fitted(docs), entries(test, "label", "split"))


def cross_validated(docs: DataFrame, k: int = CV_FOLDS) -> DataFrame:
    train = splits.folds(docs.filter(F.col("split") == "train"), k)
    return crossval.cross_validate(
        entries(train, "label", "fold"),
        k,
        tfidf=True,
        vocabulary_size=NUM_FEATURES,
    )
