"""Every query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalize, tokens
from ..functions.hashing import hash_bucket
from ..functions.terms import ngrams, word_terms
from ..functions.wordlists import COMMON_CONTRACTIONS, MOJIBAKE_QUOTE, STOP_WORDS
from ..operators import crossval, evaluate, features, lookup, naive_bayes, prepare, ranking, splits
from ..operators.training_state import TrainingState
from ..sources import (
    SENTIMENT_CLASSES,
    bind_positions,
    labelled_conversations,
    labelled_documents,
    read_csv,
    read_csv_checked,
    read_dictionary,
    read_dictionary_table,
    read_runs,
    read_table,
    write_csv,
    write_dictionary,
    write_dictionary_table,
    write_run,
)
from ..storage import materialise, new_path
from . import hashed, vocabulary

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
ROLE_LABELS = {"assistant": 0, "user": 1}
ROLE_OTHER = 2
REPLICAS = 8
SPLIT_WEIGHTS = (0.1, 0.025, 0.875)
SPLIT_SEED = 1
EXACT_SEED = 69


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return prepare.drop_nulls(rows, "text")


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that the order of a sum does not show."""
    return df.select(
        *[
            F.round(name, DIGITS).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _joined(words: Column) -> Column:
    # Tokens hold no white space, so a text with single spaces stands for the list.
    return F.array_join(words, " ")


# -- sources ---------------------------------------------------------------------------

CSV_COLUMNS = ["doc_id", "sentiment", "text"]


def _csv_copy(spark: SparkSession, sf_dir: str, encoding: str) -> str:
    rows = labelled_documents(spark, sf_dir).select(*CSV_COLUMNS)
    return write_csv(rows, new_path(spark, "csv"), encoding)


def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six columns under other names, bound at 0 and 5; numeric labels; whitelist; null rows out."""
    grade = F.when(F.col("sentiment") == "negative", "0").when(F.col("sentiment") == "positive", "4").otherwise("2")
    wide = labelled_documents(spark, sf_dir).select(
        F.when(F.col("doc_id") % 11 == 0, "9").otherwise(grade).alias("a"),
        F.col("doc_id").alias("b"),
        F.lit("date").alias("c"),
        F.lit("flag").alias("d"),
        F.lit("user").alias("e"),
        F.when(F.col("doc_id") % 13 != 0, F.col("text")).alias("f"),
    )
    path = write_csv(wide, new_path(spark, "csv"), "UTF-8")
    rows = read_csv(spark, path, ["c0", "c1", "c2", "c3", "c4", "c5"], multi_line=True)
    bound = bind_positions(rows, {0: "sentiment", 5: "text"})
    kept = prepare.drop_nulls(prepare.keep_labels(bound, "sentiment", ["0", "2", "4"]))
    return prepare.encode_label(kept, "sentiment", prepare.NUMERIC_LABELS)


def load_csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_copy(spark, sf_dir, "ISO-8859-1")
    rows = read_csv(spark, path, CSV_COLUMNS, encoding="ISO-8859-1", multi_line=True)
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def load_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-line records: a text ends at its first line break, the rest is filtered out.

    Texts are written without quotes of their own, which a cut record could not close.
    """
    bare = F.replace(F.col("text"), F.lit('"'), F.lit(""))
    rows = labelled_documents(spark, sf_dir).select("doc_id", "sentiment", bare.alias("text"))
    path = write_csv(rows, new_path(spark, "csv"), "UTF-8")
    rows = read_csv(spark, path, CSV_COLUMNS)
    kept = prepare.keep_labels(rows, "sentiment", SENTIMENT_CLASSES)
    return kept.select(F.col("doc_id").cast("bigint").alias("doc_id"), "sentiment", "text")


def load_csv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per sentiment and broken records per reason, from a file with planted faults, written as repeated runs."""
    rows = labelled_documents(spark, sf_dir)
    size = F.length("text").cast("string")
    key = F.col("doc_id").cast("string")
    line = (
        F.when(F.col("doc_id") % 7 == 0, F.concat_ws(",", key, "sentiment"))
        .when(F.col("doc_id") % 11 == 0, F.concat_ws(",", F.concat(F.lit("no"), key), "sentiment", size))
        .when(F.col("doc_id") % 13 == 0, F.concat_ws(",", key, F.lit(""), size))
        .when(F.col("doc_id") % 17 == 0, F.concat_ws(",", key, "sentiment", size, F.lit("more")))
        .otherwise(F.concat_ws(",", key, "sentiment", size))
    )
    path = new_path(spark, "csv")
    rows.select(line.alias("value")).write.text(path)
    columns = {"doc_id": "bigint", "sentiment": "string", "n_chars": "int"}
    good, broken = read_csv_checked(spark, path, columns, ["sentiment"], header=False)
    kept, aside = new_path(spark, "rows"), new_path(spark, "quarantine")
    # The first attempt at the second run fails after some of its rows; the repetition replaces it.
    for run, part in (("0", good.filter("doc_id % 2 = 0")), ("1", good.filter("doc_id % 3 = 1")), ("1", good.filter("doc_id % 2 = 1"))):
        write_run(part, kept, run, "sentiment")
    write_run(broken, aside, "0", "reason")
    good_counts = read_runs(spark, kept).groupBy(F.col("sentiment").alias("kind")).agg(
        F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars")
    )
    broken_counts = read_runs(spark, aside).groupBy(F.col("reason").alias("kind")).agg(
        F.count("*").alias("n_rows"), F.lit(None).cast("long").alias("n_chars")
    )
    return good_counts.unionByName(broken_counts)


# -- preparation -----------------------------------------------------------------------


def project_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_documents(spark, sf_dir).select("sentiment", "text")


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.profile_columns(read_table(spark, sf_dir, "documents"))


def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts from merged sketches of three parts of the table, held against the exact ones."""
    table = read_table(spark, sf_dir, "documents")
    parts = [prepare.sketch_columns(table.filter(F.pmod(F.xxhash64(*table.columns), F.lit(3)) == i)) for i in range(3)]
    estimated = prepare.estimate_distinct(materialise(prepare.merge_sketches(*parts), "column-sketches"))
    exact = prepare.exact_distinct(table, table.columns).withColumnRenamed("n_distinct", "n_exact")
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    # Four standard errors.
    near = off <= F.greatest(F.lit(1.0), 4 * prepare.SKETCH_ERROR * F.col("n_exact"))
    return estimated.join(exact, "column_name").select(
        "position", "column_name", "n_rows", "n_present", "n_exact", near.alias("within_error")
    )


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_documents(spark, sf_dir).orderBy("doc_id").limit(20)


def filter_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.keep_labels(labelled_documents(spark, sf_dir), "sentiment", ["positive", "negative"])
    return rows.select("doc_id", "sentiment")


def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = documents.join(labels, "doc_id", "left")
    return prepare.drop_nulls(rows, "text", "quality").select("doc_id", "quality")


def encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.encode_label(labelled_documents(spark, sf_dir), "sentiment").select(
        "doc_id", "sentiment", "label"
    )


def encode_label_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    code = (F.col("quality") * 4 - F.col("toxic") * F.col("quality") * 2).cast("string")
    rows = labels.select("doc_id", code.alias("sentiment"))
    return prepare.encode_label(rows, "sentiment", prepare.NUMERIC_LABELS)


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.class_counts(labelled_documents(spark, sf_dir), "sentiment")


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.dedup_rows(labelled_documents(spark, sf_dir), ["sentiment", "text"])


def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_label(spark, sf_dir).select("label").distinct()


def union_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = prepare.replicate(labelled_documents(spark, sf_dir).select("doc_id", "sentiment"), REPLICAS)
    return copies.groupBy("doc_id", "sentiment").agg(F.count("*").alias("n_rows"))


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct terms of each part: the shape of its feature matrix."""
    docs = vocabulary.with_vectors(vocabulary.prepared(spark, sf_dir))
    rows = vocabulary.scored_entries(docs)
    by_split = rows.groupBy("split", "term").agg(F.count("*").alias("df"))
    is_doc = F.col("term") == ""
    return by_split.groupBy("split").agg(
        F.sum(F.when(is_doc, F.col("df"))).alias("n_rows"), F.count_if(~is_doc).alias("n_terms")
    )


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.train_test(read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return rows.select("doc_id", "quality", "split")


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents").select("doc_id")
    return splits.weighted_split(rows, SPLIT_WEIGHTS, SPLIT_SEED)


def exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "labels").select("doc_id")
    return splits.exact_split(rows, (3, 10), vocabulary.CV_FOLDS, EXACT_SEED)


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "labels").select("doc_id")
    return splits.folds(rows, vocabulary.CV_FOLDS)


# -- token cleaning --------------------------------------------------------------------


def _per_document(change: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _documents(spark, sf_dir).select("doc_id", change(F.col("text")).alias("result"))

    return run


def _tweet_like(change: Callable[[Column], Column]) -> Query:
    """Over all documents, with tweet marks put in the place of commas and full stops."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _documents(spark, sf_dir).select(
            "doc_id", change(tweet_text(F.col("text"))).alias("result")
        )

    return run


# What a comma, a full stop and a line break become in the derived texts.
COMMA_MARKS = " :) they'll, @some.one &quot;we've&quot; :-( : ) ( : :') :O :D <3 "
STOP_MARKS = " http://t.co/x4 you're ;) &amp; don't (: www.a.org :* #1 2nd. :-) (-: ;-) (; (-; ;D @-) xD "
BREAK_MARKS = "\n :'( we're a-b :-/ We've ok : ( ): )-: ) : :-| :,( :\"( :-D x-D "


def tweet_text(text: Column) -> Column:
    text = F.replace(text, F.lit(", "), F.lit(COMMA_MARKS))
    text = F.replace(text, F.lit(". "), F.lit(STOP_MARKS))
    return F.replace(text, F.lit("\n"), F.lit(BREAK_MARKS))


def norm_contractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the dictionary read back from a JSON file."""
    path = write_dictionary(spark, new_path(spark, "dictionary"), COMMON_CONTRACTIONS)
    texts = _documents(spark, sf_dir).select(
        "doc_id", tweet_text(F.col("text")).alias("text"), read_dictionary(spark, path).alias("dictionary")
    )
    expanded = normalize.expand_contractions(F.lower("text"), F.col("dictionary"))
    return texts.select("doc_id", expanded.alias("result"))


def norm_contractions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the dictionary as a table of one entry per row, stored and read line by line."""
    rows = spark.createDataFrame(list(COMMON_CONTRACTIONS.items()), "short string, long string")
    path = write_dictionary_table(rows, new_path(spark, "dictionary"))
    texts = _documents(spark, sf_dir).select("doc_id", F.lower(tweet_text(F.col("text"))).alias("result"))
    return lookup.expand_from_table(texts, read_dictionary_table(spark, path, lines=True), text="result")


def _words(text: Column) -> Column:
    return tokens.drop_empty(F.split(text, f"[{tokens.SPACE}]"))


# -- features --------------------------------------------------------------------------


def _word_entries(spark: SparkSession, sf_dir: str, low: int, high: int) -> DataFrame:
    docs = _documents(spark, sf_dir)
    terms = ngrams(word_terms(normalize.normalize_text(F.col("text"))), low, high)
    return features.unfold(docs, features.term_vector(terms), ["doc_id"])


def _long_count() -> Column:
    # Stored vectors hold ints; results show counts as the long that a count is elsewhere.
    return F.col("tf").cast("bigint").alias("tf")


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = features.real_terms(_word_entries(spark, sf_dir, 1, 1))
    return entries.select("doc_id", "term", _long_count())


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.with_vectors(vocabulary.prepared(spark, sf_dir))
    entries = features.real_terms(vocabulary.entries(docs))
    return entries.select("doc_id", "term", _long_count())


def vocabulary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary(features.real_terms(_word_entries(spark, sf_dir, 1, 2)))


def hashing_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.ml_hashing_tf(hashed.words(spark, sf_dir), "words")


def hash_bucket_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = features.real_terms(hashed.entries(hashed.vectors(spark, sf_dir)))
    return entries.select("doc_id", F.col("term").alias("bucket"), _long_count())


def _bucket_idf(counts: naive_bayes.Counts) -> DataFrame:
    idf = features.idf_plain(counts.train_df, counts.n_train)
    known = counts.terms.filter(counts.train_df > 0)
    return known.select("term", counts.train_df.alias("df"), idf.alias("idf"))


def _bucket_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = hashed.vectors(spark, sf_dir)
    counts = hashed.counts(docs)
    train = hashed.entries(docs.filter(F.col("split") == "train"), "label")
    idf = _bucket_idf(counts).select("term", "idf")
    return features.tfidf(features.real_terms(train), idf, counts.hot)


def idf_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = hashed.counts(hashed.vectors(spark, sf_dir))
    return _rounded(_bucket_idf(counts).withColumnRenamed("term", "bucket"))


def tfidf_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = _bucket_weights(spark, sf_dir)
    return _rounded(weighted.select("doc_id", F.col("term").alias("bucket"), "tfidf"))


def tfidf_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    counts = vocabulary.counts(docs)
    train = vocabulary.entries(docs.filter(F.col("split") == "train"))
    idf = naive_bayes.smooth_idf_table(counts)
    weighted = features.tfidf(features.real_terms(train), idf, counts.hot)
    return _rounded(features.unit_length(weighted).select("doc_id", "term", "tfidf"))


# -- models ----------------------------------------------------------------------------


def labelled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _bucket_weights(spark, sf_dir).groupBy("doc_id", "label").agg(
        F.count("*").alias("n_features"), F.sum("tfidf").alias("total")
    )
    return _rounded(points)


def nb_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes after the deduplication; no text is cleaned or moved for them."""
    train = hashed.survivors(spark, sf_dir).filter(F.col("split") == "train")
    sizes = train.groupBy("label").agg(F.count("*").alias("n_docs"))
    # One row per class.
    everything = Window.partitionBy()
    total, classes = F.sum("n_docs").over(everything), F.count("*").over(everything)
    return _rounded(
        sizes.select(
            "label",
            "n_docs",
            F.log(F.col("n_docs") / total).alias("log_prior"),
            F.log((F.col("n_docs") + 1.0) / (total + classes)).alias("log_prior_smoothed"),
        )
    )


def _word_counts(spark: SparkSession, sf_dir: str) -> naive_bayes.Counts:
    # A single pass over the texts, so nothing is stored before the counts.
    return vocabulary.counts(vocabulary.with_vectors(vocabulary.prepared(spark, sf_dir)))


def nb_model_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = naive_bayes.fit_counts(_word_counts(spark, sf_dir))
    return _rounded(naive_bayes.log_likelihoods(model))


def nb_model_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = hashed.fitted(hashed.vectors(spark, sf_dir))
    return _rounded(naive_bayes.log_likelihoods(model).withColumnRenamed("term", "bucket"))


def nb_model_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _word_counts(spark, sf_dir)
    logs = [
        F.log((F.col(f"df_{c}") + 1.0) / (counts.n_docs[c] + 2.0)).alias(f"logp_{c}")
        for c in counts.classes
    ]
    return _rounded(counts.terms.select("term", *logs))


def nb_model_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    model = vocabulary.fit_tfidf(docs)
    return _rounded(naive_bayes.log_likelihoods(model))


def nb_spark_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hashed.predictions(hashed.vectors(spark, sf_dir)))


def _count_predictions(docs: DataFrame, part: str | None = None) -> DataFrame:
    model = naive_bayes.fit_counts(vocabulary.counts(docs))
    wanted = docs if part is None else docs.filter(F.col("split") == part)
    return vocabulary.predictions(model, wanted)


def nb_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_count_predictions(vocabulary.labelled_vectors(spark, sf_dir)))


def nb_bernoulli_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    model = naive_bayes.fit_bernoulli(vocabulary.counts(docs))
    return _rounded(vocabulary.predictions(model, docs))


def nb_tfidf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    model = vocabulary.fit_tfidf(docs)
    return _rounded(vocabulary.predictions(model, docs))


def nb_train_vocabulary_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary is what training documents hold; what only test documents hold is left out."""
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    model = naive_bayes.fit_counts(naive_bayes.training_vocabulary(vocabulary.counts(docs)))
    return _rounded(vocabulary.predictions(model, docs, known_only=True))


def _grown_state(spark: SparkSession, sf_dir: str, entries: Callable[..., DataFrame], docs: DataFrame) -> TrainingState:
    state = TrainingState(spark, new_path(spark, "training-state"))
    for part in (0, 1, 2):
        state.add(f"part{part}", entries(docs.filter(F.col("doc_id") % 3 == part), "label", "split"))
    return state


def nb_model_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count model from three sets of documents that were added one after the other."""
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    state = _grown_state(spark, sf_dir, vocabulary.entries, docs)
    return _rounded(naive_bayes.log_likelihoods(naive_bayes.fit_counts(state.counts())))


def nb_grown_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The TF-IDF model of buckets from a grown and compacted state, with its IDF refitted from the sums."""
    docs = hashed.vectors(spark, sf_dir)
    state = _grown_state(spark, sf_dir, hashed.entries, docs).compacted(new_path(spark, "training-state"))
    model = naive_bayes.fit_plain_tfidf(state.counts(), features.NUM_FEATURES)
    return _rounded(naive_bayes.predict(model, hashed.entries(docs, "label", "split")))


def nb_ml_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job with ``pyspark.ml`` stages, on the same bucket numbers."""
    bucket = F.transform("words", lambda w: hash_bucket(w, features.NUM_FEATURES).cast("string"))
    words = hashed.words(spark, sf_dir)
    rows = materialise(words.select("doc_id", "label", "split", bucket.alias("buckets")), "clean-buckets")
    numbers = [str(i) for i in range(features.NUM_FEATURES)]
    model = Pipeline(
        stages=[
            CountVectorizerModel.from_vocabulary(numbers, inputCol="buckets", outputCol="counts"),
            IDF(inputCol="counts", outputCol="features"),
            NaiveBayes(smoothing=1.0, modelType="multinomial"),
        ]
    ).fit(rows.filter(F.col("split") == "train"))
    return model.transform(rows).select(
        "doc_id", "label", "split", F.col("prediction").cast("int").alias("prediction")
    )


def nb_roles_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second labelled set: the role of a conversation turn, on word counts."""
    rows = prepare.drop_nulls(labelled_conversations(spark, sf_dir), "text", "role")
    rows = prepare.encode_label(rows, "role", ROLE_LABELS, ROLE_OTHER)
    return _rounded(_count_predictions(vocabulary.stored_vectors(splits.train_test(rows))))


def score_new_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vocabulary.score_new(spark, sf_dir))


def score_new_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vocabulary.score_new_stream(spark, sf_dir))


def score_stream_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vocabulary.score_versioned(spark, sf_dir))


# -- evaluation ------------------------------------------------------------------------


def accuracy_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hashed.predictions(hashed.vectors(spark, sf_dir))
    return _rounded(evaluate.accuracy(scored, "split"))


def accuracy_replicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load form: every labelled document eight times, without deduplication."""
    docs = hashed.replicated_vectors(spark, sf_dir, REPLICAS)
    return _rounded(evaluate.accuracy(hashed.predictions(docs), "split"))


def accuracy_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and test accuracy of the three vocabulary models, scored side by side."""
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    counts = vocabulary.unit_counts(docs)
    models = {
        "multinomial": naive_bayes.fit_counts(counts),
        "bernoulli": naive_bayes.fit_bernoulli(counts),
        "tfidf": naive_bayes.fit_unit_tfidf(counts),
    }
    scored = vocabulary.predictions(models, docs)
    return _rounded(evaluate.accuracy_of_models(scored, list(models), "split"))


def exact_split_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models trained on exactly eight tenths of the labelled documents."""
    keys = read_table(spark, sf_dir, "labels").select("doc_id")
    parts = splits.exact_split(keys, (2, 10), vocabulary.CV_FOLDS, EXACT_SEED).drop("fold")
    rows = prepare.drop_nulls(labelled_documents(spark, sf_dir), "text", "sentiment")
    rows = prepare.encode_label(rows, "sentiment").select("doc_id", "label", "text")
    docs = vocabulary.stored_vectors(rows.join(parts, "doc_id"))
    counts = vocabulary.counts(docs)
    models = {"multinomial": naive_bayes.fit_counts(counts), "bernoulli": naive_bayes.fit_bernoulli(counts)}
    scored = vocabulary.predictions(models, docs)
    return _rounded(evaluate.accuracy_of_models(scored, list(models), "split"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    return evaluate.confusion_matrix(_count_predictions(docs, "test"))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    return _rounded(evaluate.classification_report(_count_predictions(docs, "test")))


def _bucket_test_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed.test_predictions(hashed.vectors(spark, sf_dir))


def per_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.per_class_metrics(_bucket_test_predictions(spark, sf_dir)))


def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.weighted_metrics(_bucket_test_predictions(spark, sf_dir)))


def auc_from_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.auc_from_classes(_bucket_test_predictions(spark, sf_dir)))


def auc_from_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same positives, ranked by the log-odds of the classes above the lowest instead of the class id."""
    scored = _bucket_test_predictions(spark, sf_dir)
    above = -ranking.log_odds(naive_bayes.CLASSES[0], naive_bayes.CLASSES)
    return _rounded(ranking.auc(scored.select(above.alias("score"), (F.col("label") > 0.5).alias("positive"))))


def auc_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each class against the rest on the test part, by its own log-odds."""
    scored = _count_predictions(vocabulary.labelled_vectors(spark, sf_dir), "test")
    return _rounded(ranking.auc(ranking.one_vs_rest(scored, naive_bayes.CLASSES), ["label"]))


def cv_fold_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hashed.cross_validated(hashed.vectors(spark, sf_dir))
    return _rounded(crossval.fold_accuracy(scored))


def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = vocabulary.cross_validated(vocabulary.labelled_vectors(spark, sf_dir))
    return _rounded(crossval.summarise_folds(crossval.fold_accuracy(scored)))


def cv_train_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy per fold with the vocabulary refitted on the other folds."""
    docs = vocabulary.labelled_vectors(spark, sf_dir)
    return _rounded(crossval.fold_accuracy(vocabulary.cross_validated(docs, training_vocabulary=True)))


def cv_vocabulary_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that only one fold holds, and the vocabulary without it."""
    docs = vocabulary.with_vectors(vocabulary.prepared(spark, sf_dir))
    return crossval.vocabulary_sizes(vocabulary.folded_entries(docs))


QUERIES: dict[str, Query] = {
    "load_csv": load_csv,
    "load_csv_latin1": load_csv_latin1,
    "load_csv_lines": load_csv_lines,
    "load_csv_checked": load_csv_checked,
    "project_labelled": project_labelled,
    "profile_columns": profile_columns,
    "profile_sketches": profile_sketches,
    "first_rows": first_rows,
    "filter_labels": filter_labels,
    "drop_nulls": drop_nulls,
    "encode_label": encode_label,
    "encode_label_numeric": encode_label_numeric,
    "class_counts": class_counts,
    "dedup_rows": dedup_rows,
    "distinct_labels": distinct_labels,
    "union_replicate": union_replicate,
    "split_counts": split_counts,
    "hash_split": hash_split,
    "random_split": random_split,
    "exact_split": exact_split,
    "cv_folds": cv_folds,
    "lower_text": _per_document(F.lower),
    "tokenize_ws": _per_document(lambda t: F.array_join(tokens.tokenize(t), "|")),
    "token_placeholders": _tweet_like(
        lambda t: _joined(_words(tokens.mark_mentions_and_links(F.lower(t))))
    ),
    "squeeze_runs": _per_document(lambda t: _joined(_words(tokens.squeeze_runs(F.lower(t))))),
    "drop_number_led": _tweet_like(
        lambda t: _joined(_words(tokens.drop_number_led(F.lower(t))))
    ),
    "remove_stopwords": _per_document(
        lambda t: _joined(
            tokens.drop_empty(
                tokens.remove_stop_words(tokens.tokenize(t), [*STOP_WORDS, MOJIBAKE_QUOTE])
            )
        )
    ),
    "strip_punct": _tweet_like(
        lambda t: _joined(tokens.drop_empty(tokens.strip_punctuation(tokens.tokenize(t))))
    ),
    "clean_tokens": _per_document(lambda t: _joined(tokens.clean_tokens(t))),
    "clean_tokens_tweets": _tweet_like(lambda t: _joined(tokens.clean_tokens(t))),
    "clean_tokens_128": _tweet_like(
        lambda t: _joined(
            tokens.clean_tokens(F.concat(t, F.lit(f" {MOJIBAKE_QUOTE} end")), [*STOP_WORDS, MOJIBAKE_QUOTE])
        )
    ),
    "norm_basic": _tweet_like(normalize.normalize_basic),
    "norm_emoticons": _tweet_like(lambda t: normalize.replace_emoticons(F.lower(t))),
    "norm_single_letters": _tweet_like(lambda t: normalize.drop_single_letters(F.lower(t))),
    "norm_contractions": norm_contractions,
    "norm_contractions_table": norm_contractions_table,
    "norm_punct": _tweet_like(lambda t: normalize.blank_punctuation(F.lower(t))),
    "squeeze_to_two": _per_document(normalize.squeeze_to_two),
    "normalize_text": _per_document(normalize.normalize_text),
    "normalize_tweets": _tweet_like(normalize.normalize_text),
    "term_counts": term_counts,
    "ngram_counts": ngram_counts,
    "vocabulary": vocabulary_table,
    "hashing_tf": hashing_tf,
    "hash_bucket_tf": hash_bucket_tf,
    "idf_spark": idf_spark,
    "tfidf_spark": tfidf_spark,
    "tfidf_l2": tfidf_l2,
    "labelled_points": labelled_points,
    "nb_priors": nb_priors,
    "nb_model_counts": nb_model_counts,
    "nb_model_spark": nb_model_spark,
    "nb_model_bernoulli": nb_model_bernoulli,
    "nb_model_tfidf": nb_model_tfidf,
    "nb_spark_predict": nb_spark_predict,
    "nb_predict": nb_predict,
    "nb_bernoulli_predict": nb_bernoulli_predict,
    "nb_tfidf_predict": nb_tfidf_predict,
    "nb_train_vocabulary_predict": nb_train_vocabulary_predict,
    "nb_model_grown": nb_model_grown,
    "nb_grown_predict": nb_grown_predict,
    "nb_ml_stages": nb_ml_stages,
    "nb_roles_predict": nb_roles_predict,
    "score_new_docs": score_new_docs,
    "score_new_stream": score_new_stream,
    "score_stream_versions": score_stream_versions,
    "accuracy_by_split": accuracy_by_split,
    "accuracy_replicated": accuracy_replicated,
    "accuracy_by_model": accuracy_by_model,
    "exact_split_models": exact_split_models,
    "confusion_matrix": confusion_matrix,
    "classification_report": classification_report,
    "per_class_metrics": per_class_metrics,
    "weighted_metrics": weighted_metrics,
    "auc_from_classes": auc_from_classes,
    "auc_from_scores": auc_from_scores,
    "auc_by_class": auc_by_class,
    "cv_fold_accuracy": cv_fold_accuracy,
    "cv_summary": cv_summary,
    "cv_train_vocabulary": cv_train_vocabulary,
    "cv_vocabulary_sizes": cv_vocabulary_sizes,
}
