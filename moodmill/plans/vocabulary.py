"""String cleaning, a full vocabulary of words and word pairs, and three Naive Bayes forms."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import normalize_text
from ..functions.terms import ngrams, word_terms
from ..operators import crossval, naive_bayes, prepare, splits
from ..operators.features import term_vector, unfold
from ..sources import labelled_documents, read_table
from ..storage import materialise, new_path
from ..streaming.score import score_stream
from ..streaming.versions import ModelStore, read_scores, score_versioned_stream

CV_FOLDS = 10


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label, text, split``; copies stay, as each counts as a document of its own."""
    rows = prepare.drop_nulls(labelled_documents(spark, sf_dir), "text", "sentiment")
    rows = prepare.encode_label(rows, "sentiment").select("doc_id", "label", "text")
    return splits.train_test(rows)


def with_vectors(docs: DataFrame) -> DataFrame:
    """``doc_id, label, split, vector``: counted words and word pairs of the normalised text."""
    vector = term_vector(ngrams(word_terms(normalize_text(F.col("text")))))
    return docs.select("doc_id", "label", "split", vector.alias("vector"))


def stored_vectors(docs: DataFrame) -> DataFrame:
    """The same, written once: training, lengths and scoring all read the counted terms."""
    return materialise(with_vectors(docs), "term-vectors")


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_vectors(prepared(spark, sf_dir))


def entries(docs: DataFrame, *keep: str) -> DataFrame:
    return unfold(docs, F.col("vector"), ["doc_id", *keep])


def scored_entries(docs: DataFrame) -> DataFrame:
    return entries(docs, "label", "split")


def counts(docs: DataFrame) -> naive_bayes.Counts:
    """The vocabulary covers training and test documents; class counts only training ones."""
    return naive_bayes.count_training(scored_entries(docs))


def unit_counts(docs: DataFrame) -> naive_bayes.Counts:
    """The same with the masses of unit-length documents, from a single wide count."""
    return naive_bayes.count_unit_training(docs, entries)


def fit_tfidf(docs: DataFrame, score_on: str = "count") -> naive_bayes.Model:
    return naive_bayes.fit_unit_tfidf(unit_counts(docs), score_on)


def predictions(
    models: naive_bayes.Model | dict[str, naive_bayes.Model], docs: DataFrame, known_only: bool = False
) -> DataFrame:
    """``doc_id, label, split`` and the prediction of one model or of several.

    Only the key travels with the terms; label and split meet the result once per document.
    """
    if isinstance(models, dict):
        scored = naive_bayes.predict_all(models, entries(docs), ["doc_id"], known_only)
    else:
        scored = naive_bayes.predict(models, entries(docs), ["doc_id"], known_only)
    return docs.select("doc_id", "label", "split").join(scored, "doc_id")


def score_texts(model: naive_bayes.Model, docs: DataFrame) -> DataFrame:
    """Score new ``doc_id, text`` rows: no string cleaning, and unknown terms are dropped.

    The texts are read and counted once; what travels afterwards comes from the stored vectors.
    """
    model = replace(model, hot=None)
    vector = term_vector(ngrams(word_terms(F.col("text")))).alias("vector")
    vectors = materialise(prepare.drop_nulls(docs, "text").select("doc_id", vector), "new-vectors")
    return naive_bayes.predict(model, entries(vectors), ["doc_id"], known_only=True)


def score_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark texts as new documents."""
    docs = labelled_vectors(spark, sf_dir)
    model = fit_tfidf(docs, "tfidf")
    texts = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return score_texts(model, texts)


def score_new_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts read as a stream of files; returns the stored predictions."""
    docs = labelled_vectors(spark, sf_dir)
    model = fit_tfidf(docs, "tfidf")
    schema = read_table(spark, sf_dir, "benchmark").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "benchmark.parquet")
    texts = files.parquet(sf_dir).select(F.col("item_id").alias("doc_id"), "text")
    out, progress = new_path(spark, "scored"), new_path(spark, "progress")
    query = score_stream(texts, lambda batch: score_texts(model, batch), out, progress)
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch")


def score_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in two files: the second arrives after a second model has been published."""
    docs = labelled_vectors(spark, sf_dir)
    texts = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    store = ModelStore(spark, new_path(spark, "models"))
    arriving, out, progress = (new_path(spark, name) for name in ("arriving", "scored", "progress"))
    models = (lambda: fit_tfidf(docs, "tfidf"), lambda: naive_bayes.fit_counts(counts(docs)))
    for part, fit in enumerate(models):
        store.publish(fit())
        texts.filter(F.col("doc_id") % 2 == part).coalesce(1).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(texts.schema).parquet(arriving)
        score_versioned_stream(stream, store, score_texts, out, progress).awaitTermination()
    return read_scores(spark, out).drop("batch")


def folded_entries(docs: DataFrame, k: int = CV_FOLDS) -> DataFrame:
    """Entries with the fold of training documents; those of the others have none."""
    fold = F.when(F.col("split") == "train", F.col("fold"))
    return entries(splits.folds(docs, k).withColumn("fold", fold), "label", "fold")


def cross_validated(docs: DataFrame, k: int = CV_FOLDS, training_vocabulary: bool = False) -> DataFrame:
    """Folds of the training part; the vocabulary is that of all documents, or of the other folds only."""
    return crossval.cross_validate(folded_entries(docs, k), k, tfidf=False, training_vocabulary=training_vocabulary)
