"""Training state by deltas, vocabularies without other documents, and models stored as versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodmill.functions.terms import NO_TERM
from moodmill.operators import crossval, naive_bayes
from moodmill.operators.training_state import TrainingState
from moodmill.storage import is_complete, new_path
from moodmill.streaming.versions import ModelStore, pinned_version, read_scores, score_versioned_stream

WORDS = ["sun", "rain", "wind", "snow", "fog", "hail", "dew"]


def documents(n=90, seed=2):
    rng = random.Random(seed)
    return [
        (i, rng.randrange(3), rng.choice(["train", "train", "test"]), rng.choices(WORDS[: 3 + i % 5], k=rng.randrange(0, 6)))
        for i in range(n)
    ]


def entries_of(spark, docs):
    rows = []
    for key, label, split, words in docs:
        rows += [(key, label, split, term, tf) for term, tf in [(NO_TERM, 1), *Counter(words).items()]]
    return spark.createDataFrame(rows, "doc_id long, label int, split string, term string, tf int")


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_merged_parts_equal_one_count(spark):
    docs = documents()
    state = TrainingState(spark, new_path(spark, "state"))
    state.add("a", entries_of(spark, docs[:30]))
    state.add("b", entries_of(spark, docs[30:31]))
    state.add("c", entries_of(spark, docs[31:]))
    whole = naive_bayes.count_training(entries_of(spark, docs))
    grown = state.counts()
    assert rows_of(grown.table) == rows_of(whole.table)
    assert (grown.n_docs, grown.classes) == (whole.n_docs, whole.classes)
    asked = entries_of(spark, docs)
    for fit in (naive_bayes.fit_counts, naive_bayes.fit_bernoulli, lambda c: naive_bayes.fit_plain_tfidf(c, 100)):
        one, other = (naive_bayes.predict(fit(c), asked) for c in (whole, grown))
        assert {r.doc_id: r.prediction for r in one.collect()} == {r.doc_id: r.prediction for r in other.collect()}
    small = state.compacted(new_path(spark, "state"))
    assert rows_of(small.table()) == rows_of(whole.table)


def test_adding_a_set_again_replaces_it_and_reads_no_other(spark):
    docs = documents()
    state = TrainingState(spark, new_path(spark, "state"))
    state.add("a", entries_of(spark, docs[:50]))
    state.add("b", entries_of(spark, docs[:90]))  # a failed attempt that counted too much
    state.add("b", entries_of(spark, docs[50:]))
    assert rows_of(state.table()) == rows_of(naive_bayes.count_training(entries_of(spark, docs)).table)


def test_a_class_that_only_a_later_set_has(spark):
    docs = [(1, 0, "train", ["sun"]), (2, 2, "train", ["rain", "sun"])]
    state = TrainingState(spark, new_path(spark, "state"))
    state.add("a", entries_of(spark, docs[:1]))
    assert state.counts().classes == (0,)
    state.add("b", entries_of(spark, docs[1:]))
    assert state.counts().n_docs == {0: 1, 2: 1}


def expected_class(train, words):
    """Multinomial on the words of ``train`` only, from the definition."""
    vocabulary = {w for _, _, _, ws in train for w in ws}
    scores = []
    for c in sorted({label for _, label, _, _ in train}):
        own = [ws for _, label, _, ws in train if label == c]
        counts = Counter(w for ws in own for w in ws)
        score = math.log(len(own) / len(train))
        for w in words:
            if w in vocabulary:
                score += math.log((counts[w] + 1) / (counts.total() + len(vocabulary)))
        scores.append((-round(score, 9), c))
    return min(scores)[1]


def test_training_vocabulary_ignores_what_only_test_documents_hold(spark):
    docs = [*documents(), (500, 0, "test", ["unseen"] * 3 + ["sun"])]
    counts = naive_bayes.training_vocabulary(naive_bayes.count_training(entries_of(spark, docs)))
    model = naive_bayes.fit_counts(counts)
    got = {r.doc_id: r.prediction for r in naive_bayes.predict(model, entries_of(spark, docs), known_only=True).collect()}
    train = [d for d in docs if d[2] == "train"]
    assert got == {d[0]: expected_class(train, d[3]) for d in docs}


def test_folds_with_their_own_vocabulary(spark):
    docs = [*documents(), (500, 0, "train", ["solo", "solo"]), (503, 1, "test", ["outside"])]
    fold = F.when(F.col("split") == "train", (F.col("doc_id") % 4).cast("int"))
    entries = entries_of(spark, docs).withColumn("fold", fold)
    scored = crossval.cross_validate(entries, 4, tfidf=False, training_vocabulary=True)
    train = [d for d in docs if d[2] == "train"]
    wanted = {d[0]: expected_class([t for t in train if t[0] % 4 != d[0] % 4], d[3]) for d in train}
    assert {r.doc_id: r.prediction for r in scored.collect()} == wanted
    sizes = {r.fold: (r.n_exclusive, r.n_terms) for r in crossval.vocabulary_sizes(entries).collect()}
    for f in range(4):
        own = {w for d in train if d[0] % 4 == f for w in d[3]}
        others = {w for d in train if d[0] % 4 != f for w in d[3]}
        assert sizes[f] == (len(own - others), len(others))


# -- versions ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def models(spark):
    a = [(i, i % 2, "train", ["sun"] if i % 2 else ["rain"]) for i in range(8)]
    b = [(k, 1 - label, split, words) for k, label, split, words in a]
    fit = lambda docs: naive_bayes.fit_counts(naive_bayes.count_training(entries_of(spark, docs)))
    return fit(a), fit(b)


def score_words(model, batch):
    words = F.explode(F.concat(F.array(F.lit(NO_TERM)), F.split("text", " "))).alias("term")
    entries = batch.select("doc_id", words).withColumn("tf", F.lit(1))
    return naive_bayes.predict(model, entries, ["doc_id"])


def stream_of(spark, folder):
    files = spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", 1)
    return files.parquet(folder)


def write_file(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(folder)


def test_a_stored_model_scores_as_before(spark, models):
    store = ModelStore(spark, new_path(spark, "models"))
    assert store.versions() == []
    with pytest.raises(ValueError, match="no model"):
        store.latest()
    assert [store.publish(m) for m in models] == [1, 2]
    assert (store.versions(), store.latest()) == ([1, 2], 2)
    asked = spark.createDataFrame([(1, "sun sun"), (2, "rain"), (3, "fog")], "doc_id long, text string")
    for version, model in enumerate(models, 1):
        assert rows_of(score_words(store.load(version), asked)) == rows_of(score_words(model, asked))


def test_a_stream_takes_up_a_model_midway_and_repeats_a_failed_batch(spark, models):
    store = ModelStore(spark, new_path(spark, "models"))
    store.publish(models[0])
    folder, out, progress = (new_path(spark, name) for name in ("arriving", "scored", "progress"))
    for i in range(3):
        write_file(spark, folder, [(10 * i, "sun"), (10 * i + 1, "rain")])
    tried = []

    def score(model, batch):
        tried.append(1)
        if len(tried) == 2:  # the second micro-batch fails after its version was written down
            store.publish(models[1])
            raise RuntimeError("lost")
        return score_words(model, batch)

    with pytest.raises(Exception, match="lost"):
        score_versioned_stream(stream_of(spark, folder), store, score, out, progress).awaitTermination()
    score_versioned_stream(stream_of(spark, folder), store, score, out, progress).awaitTermination()
    got = sorted((r.batch, r.model_version, r.doc_id % 10, r.prediction) for r in read_scores(spark, out).collect())
    # The repeated batch keeps the version that it had; the third meets the new one.
    assert got == [(0, 1, 0, 1), (0, 1, 1, 0), (1, 1, 0, 1), (1, 1, 1, 0), (2, 2, 0, 0), (2, 2, 1, 1)]
    assert pinned_version(store, out, 1) == 1 and is_complete(spark, f"{out}/pins/batch=2")
