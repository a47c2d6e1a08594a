"""Models against pyspark.ml, against plain Python, and on skewed or odd inputs."""

import math
import random
import re

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from moodmill.functions.terms import ngrams
from moodmill.operators import crossval, features, naive_bayes, prepare, skew, splits
from moodmill.plans import hashed, vocabulary
from moodmill.storage import materialise

BUCKETS = 64


@pytest.fixture(scope="module")
def docs(spark):
    """Random words whose mix depends on the class; one word fills a third of all entries."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        label = rng.choice([0, 1, 2, 2])
        words = [rng.choice("abcdefgh") + str(rng.randrange(3 + label)) for _ in range(rng.randrange(12))]
        words += ["hot"] * rng.randrange(6)
        rows.append((i, label, "train" if i % 3 else "test", words))
    return spark.createDataFrame(rows, "doc_id long, label int, split string, words array<string>")


def word_entries(df, *keep):
    return features.unfold(df, features.term_vector(F.col("words")), ["doc_id", *keep])


def counted(df):
    return naive_bayes.count_training(word_entries(df, "label", "split"))


def by_hand(rows, alpha=1.0):
    """Multinomial scores from the textbook, with every cell written out."""
    train = [r for r in rows if r.split == "train"]
    vocabulary_ = sorted({w for r in rows for w in r.words})
    classes = sorted({r.label for r in train})
    scores = {}
    mass = {c: {w: 0 for w in vocabulary_} for c in classes}
    for r in train:
        for w in r.words:
            mass[r.label][w] += 1
    for r in rows:
        scores[r.doc_id] = [
            math.log(sum(t.label == c for t in train) / len(train))
            + sum(
                math.log((mass[c][w] + alpha) / (sum(mass[c].values()) + alpha * len(vocabulary_)))
                for w in r.words
            )
            for c in classes
        ]
    return scores


def test_multinomial_equals_the_textbook(docs):
    want = by_hand(docs.collect())
    got = naive_bayes.predict(naive_bayes.fit_counts(counted(docs)), word_entries(docs, "label", "split"))
    rows = got.collect()
    assert len(rows) == 300
    for r in rows:
        assert [r.score_0, r.score_1, r.score_2] == pytest.approx(want[r.doc_id])
        assert r.prediction == max(range(3), key=lambda c: (round(want[r.doc_id][c], 9), -c))


def test_hashed_form_equals_ml(docs):
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=BUCKETS).transform(docs)
    train = tf.filter("split = 'train'")
    idf = IDF(inputCol="tf", outputCol="features").fit(train)
    model = NaiveBayes(smoothing=1.0).fit(idf.transform(train))
    want = {r.doc_id: int(r.prediction) for r in model.transform(idf.transform(tf)).collect()}

    long = features.ml_hashing_tf(docs, "words", BUCKETS)
    long = long.select("doc_id", F.col("bucket").alias("term"), F.col("tf").cast("int").alias("tf"))
    extra = docs.select("doc_id", F.lit(features.NO_BUCKET).alias("term"), F.lit(1).alias("tf"))
    entries = long.unionByName(extra).join(docs.drop("words"), "doc_id")
    counts = naive_bayes.count_training(entries)
    mine = naive_bayes.fit_plain_tfidf(counts, BUCKETS)
    got = {r.doc_id: r.prediction for r in naive_bayes.predict(mine, entries).collect()}
    assert got == want
    theta = model.theta.toArray()
    for r in naive_bayes.log_likelihoods(mine).collect():
        assert [r.logp_0, r.logp_1, r.logp_2] == pytest.approx(list(theta[:, r.term]))
    assert [mine.bias[c] for c in (0, 1, 2)] == pytest.approx(list(model.pi.toArray()))


def test_bernoulli_equals_the_textbook(docs):
    rows = docs.collect()
    train = [r for r in rows if r.split == "train"]
    words = {w for r in rows for w in r.words}
    n = {c: sum(r.label == c for r in train) for c in range(3)}
    p = {
        (c, w): (sum(r.label == c and w in r.words for r in train) + 1) / (n[c] + 2)
        for c in range(3)
        for w in words
    }
    model = naive_bayes.fit_bernoulli(counted(docs))
    for r in naive_bayes.predict(model, word_entries(docs, "label", "split")).collect():
        present = set(next(x for x in rows if x.doc_id == r.doc_id).words)
        want = [
            math.log(n[c] / len(train))
            + sum(math.log(p[c, w]) if w in present else math.log(1 - p[c, w]) for w in words)
            for c in range(3)
        ]
        assert [r.score_0, r.score_1, r.score_2] == pytest.approx(want)


def test_unit_tfidf_masses(docs):
    rows = docs.collect()
    train = [r for r in rows if r.split == "train"]
    words = {w for r in rows for w in r.words}
    df = {w: sum(w in r.words for r in train) for w in words}
    idf = {w: math.log((1 + len(train)) / (1 + df[w])) + 1 for w in words}
    mass = {(c, w): 0.0 for c in range(3) for w in words}
    for r in train:
        weights = {w: r.words.count(w) * idf[w] for w in set(r.words)}
        length = math.sqrt(sum(x * x for x in weights.values()))
        for w, x in weights.items():
            mass[r.label, w] += x / length
    train_docs = docs.filter("split = 'train'")
    counts = naive_bayes.with_unit_masses(counted(docs), train_docs, word_entries)
    model = naive_bayes.fit_unit_tfidf(counts)
    total = {c: sum(mass[c, w] for w in words) for c in range(3)}
    for r in naive_bayes.log_likelihoods(model).collect():
        want = [math.log((mass[c, r.term] + 1) / (total[c] + len(words))) for c in range(3)]
        assert [r.logp_0, r.logp_1, r.logp_2] == pytest.approx(want)


def test_class_without_training_documents(docs):
    gap = docs.filter((F.col("label") != 1) | (F.col("split") == "test"))
    counts = counted(gap)
    assert counts.classes == (0, 2)
    predicted = naive_bayes.predict(naive_bayes.fit_counts(counts), word_entries(gap, "label", "split"))
    assert {r.prediction for r in predicted.collect()} <= {0, 2}


def test_ties_go_to_the_lowest_class(spark):
    rows = [(0, 2, "train", ["x"]), (1, 0, "train", ["x"]), (2, 1, "train", ["x"]), (3, 0, "test", ["x"]), (4, 0, "test", [])]
    df = spark.createDataFrame(rows, "doc_id long, label int, split string, words array<string>")
    model = naive_bayes.fit_counts(counted(df))
    got = naive_bayes.predict(model, word_entries(df, "label", "split")).collect()
    assert len(got) == 5 and {r.prediction for r in got} == {0}


def test_unknown_terms_of_new_texts(docs, spark):
    model = naive_bayes.fit_counts(counted(docs))
    new = spark.createDataFrame([(1, ["a0", "zzz", "zzz"]), (2, ["a0"]), (3, ["zzz"])], "doc_id long, words array<string>")
    model.hot = None  # the new entries are counted
    rows = {r.doc_id: r for r in naive_bayes.predict(model, word_entries(new), ["doc_id"], known_only=True).collect()}
    assert rows[1].score_0 == pytest.approx(rows[2].score_0)
    assert rows[3].score_0 == pytest.approx(model.bias[0])


def test_join_per_term_with_a_hot_term(spark):
    entries = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("term"),
    )
    table = entries.select("term").distinct().filter("term <> 't1'").withColumn("w", F.length("term"))
    joined = skew.join_per_term(entries, table, skew.count_hot_keys(entries))
    assert joined.count() == 6000
    assert joined.filter("w is null").select("term").distinct().collect()[0].term == "t1"
    assert joined.filter("term = 'hot' and w = 3").count() == 2000


def test_a_small_table_is_broadcast_beside_hot_terms(spark):
    """The list of hot terms must not hide the size of the table, else all entries are moved."""
    entries = spark.range(60000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("term"),
    )
    table = materialise(entries.select("term").distinct().withColumn("w", F.length("term")), "weights")
    hot = skew.count_hot_keys(entries)
    assert [r.term for r in hot.collect()] == ["hot"]
    joined = skew.join_per_term(entries, table, hot)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert joined.filter("w is not null").count() == 60000


def test_unit_masses_from_document_lengths(spark, monkeypatch):
    """One length per key is stored, shared by rows with one key; a term of one document needs no IDF row."""
    texts = [(1, 0, "train", "aa bb bb"), (2, 2, "train", "aa cc"), (2, 2, "train", "dd"), (3, 0, "train", ""), (4, 2, "test", "aa zz")]
    docs = spark.createDataFrame(texts, "doc_id long, label int, split string, text string")
    docs = vocabulary.stored_vectors(docs)
    stored = {}

    def kept(df, name):
        stored[name] = materialise(df, name)
        return stored[name]

    monkeypatch.setattr(naive_bayes, "materialise", kept)
    got = {r.term: (r.u_0, r.u_2) for r in vocabulary.unit_counts(docs).table.collect()}
    assert sorted(r._key for r in stored["document-lengths"].collect()) == [1, 2]
    idf = {"aa": math.log(5 / 3) + 1}
    once = math.log(5 / 2) + 1
    words = {1: {"aa": 1, "bb": 2, "aa bb": 1, "bb bb": 1}, 2: {"aa": 1, "cc": 1, "aa cc": 1, "dd": 1}}
    for doc, place in ((1, 0), (2, 1)):
        length = math.sqrt(sum((n * idf.get(t, once)) ** 2 for t, n in words[doc].items()))
        for term, n in words[doc].items():
            assert got[term][place] == pytest.approx(n * idf.get(term, once) / length)
    assert got["zz"] == got["aa zz"] == (0.0, 0.0)


def test_replicated_vectors_are_stored_once(spark, small, monkeypatch):
    sizes = []

    def stored(df, name):
        table = materialise(df, name)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(hashed, "materialise", stored)
    docs = hashed.replicated_vectors(spark, small, 8)
    assert docs.count() == docs.select("doc_id").distinct().count() == 8 * sizes[0]
    assert len(sizes) == 1


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield 64
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_terms_share_work_between_tasks(spark, docs, many_partitions):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        entries = word_entries(docs, "label", "split")
        table = entries.select("term").distinct().withColumn("w", F.lit(1))
        joined = skew.join_per_term(entries, table, skew.count_hot_keys(entries)).filter("term = 'hot'")
        assert joined.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("tfidf", [True, False])
def test_cross_validation_equals_separate_fits(docs, tfidf):
    k = 3
    folded = splits.folds(docs, k)
    entries = features.unfold(folded, features.term_vector(F.col("words")), ["doc_id", "label", "fold"])
    size = features.real_terms(entries).select("term").distinct().count()
    got = {
        r.doc_id: (r.fold, r.prediction)
        for r in crossval.cross_validate(entries, k, tfidf=tfidf, vocabulary_size=size).collect()
    }
    assert len(got) == 300
    for f in range(k):
        counts = naive_bayes.count_training(entries, train=F.col("fold") != f)
        model = naive_bayes.fit_plain_tfidf(counts, size) if tfidf else naive_bayes.fit_counts(counts)
        held_out = entries.filter(F.col("fold") == f)
        for r in naive_bayes.predict(model, held_out, ["doc_id"]).collect():
            assert got[r.doc_id] == (f, r.prediction)


def test_models_side_by_side_equal_single_ones(docs):
    plain = counted(docs)
    counts = naive_bayes.with_unit_masses(plain, docs.filter("split = 'train'"), word_entries)
    models = {
        "m": naive_bayes.fit_counts(counts),
        "b": naive_bayes.fit_bernoulli(plain),
        "t": naive_bayes.fit_unit_tfidf(counts),
    }
    entries = word_entries(docs, "label", "split")
    together = {r.doc_id: r for r in naive_bayes.predict_all(models, entries).collect()}
    for name, model in models.items():
        for r in naive_bayes.predict(model, entries).collect():
            assert together[r.doc_id][f"{name}_prediction"] == r.prediction


def test_result_does_not_depend_on_partitions(docs):
    def run(df):
        model = naive_bayes.fit_counts(counted(df))
        rows = naive_bayes.predict(model, word_entries(df, "label", "split")).collect()
        return sorted((r.doc_id, r.prediction, round(r.score_0, 6)) for r in rows)

    assert run(docs) == run(docs.repartition(11, "doc_id").orderBy(F.desc("doc_id")))


def test_plans_stay_on_the_jvm(spark, small):
    docs = vocabulary.with_vectors(vocabulary.prepared(spark, small))
    rows = naive_bayes.predict(naive_bayes.fit_counts(vocabulary.counts(docs)), vocabulary.scored_entries(docs))
    buckets = hashed.predictions(hashed.vectors(spark, small))
    for df in (rows, buckets):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan
        # A scan that reads texts reads nothing else but their key; stored features need none.
        read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
        assert read and all(schema == "doc_id:bigint,text:string" for schema in read if "text" in schema)
        assert any("text" in schema for schema in read) == (df is rows)


def test_new_sentences_get_a_class(spark):
    good, bad = "What a calm crossing, warm food, friendly crew", "Delayed again, cold seats, nobody answers"
    texts = [(i, 2 if i % 2 else 0, good if i % 2 else bad, "train") for i in range(6)]
    rows = spark.createDataFrame(texts, "doc_id long, label int, text string, split string")
    model = vocabulary.fit_tfidf(vocabulary.stored_vectors(rows), "tfidf")
    new = ["warm and calm", "cold, delayed", "nobody", "friendly food", "zebra"]
    asked = spark.createDataFrame(list(enumerate(new)), "doc_id long, text string")
    got = {new[r.doc_id]: r.prediction for r in vocabulary.score_texts(model, asked).collect()}
    assert got == dict(zip(new, [2, 0, 0, 2, 0], strict=True))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved(plan):
    """What lies right below each exchange."""
    lines = plan.splitlines()
    return [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]


def test_survivors_move_digests_only(spark, small):
    plan = plan_of(hashed.survivors(spark, small))
    assert plan.count("documents.parquet") == 1 and "SortAggregate" not in plan
    assert moved(plan) and not any("text#" in below for below in moved(plan))


def test_stored_features_need_no_text(spark, small):
    plan = plan_of(hashed.vectors(spark, small))
    assert "documents.parquet" not in plan and "SortAggregate" not in plan
    assert "LeftSemi" in plan


def test_deduplicated_rows_move_no_text(spark, small):
    rows = hashed.allowed(spark, small)
    plan = plan_of(prepare.dedup_rows(rows, ["sentiment", "text"]))
    assert plan.count("documents.parquet") == 1 and "Aggregate" not in plan
    assert not any("text#" in below for below in moved(plan))


def test_no_key_outweighs_an_average_partition(spark):
    """An entry that every document carries, and 700 terms beside it, each near a whole partition."""
    partitions = 3000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rare = F.concat(F.lit("r"), F.col("id").cast("string"))
        frequent = F.concat(F.lit("t"), (F.col("id") % 700).cast("string"))
        entries = spark.range(70_000).select(
            F.col("id").alias("doc_id"), F.explode(F.array(F.lit(""), frequent, rare)).alias("term")
        )
        hot = skew.count_hot_keys(entries)
        salts = {r.term: r.salts for r in hot.collect()}
        average = 3 * 70_000 / partitions
        assert salts[""] == math.ceil(70_000 / average) and 700 < len(salts) <= partitions
        assert sum(salts.values()) <= 2 * partitions
        table = entries.select("term").distinct().withColumn("w", F.lit(1))
        joined = skew.join_per_term(entries, table, hot)
        assert joined.count() == 210_000
        salted = entries.join(hot, "term", "left").withColumn(
            "salt", F.pmod(F.xxhash64("doc_id"), F.coalesce("salts", F.lit(1)))
        )
        largest = salted.groupBy("term", "salt").count().agg(F.max("count")).first()[0]
        assert largest <= 1.5 * average  # hashing deals unevenly
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cross_validation_splits_the_common_entry(spark, docs, many_partitions):
    folded = splits.folds(docs, 2)
    entries = features.unfold(folded, features.term_vector(F.col("words")), ["doc_id", "label", "fold"])
    table = crossval.count_by_fold(entries)
    own = table.select("term", "fold", (F.col("all_df") - F.col("df")).alias("own"))
    hot = skew.hot_keys(own, entries.count(), ("term", "fold"), "own")
    salts = {(r.term, r.fold): r.salts for r in hot.collect()}
    assert salts["", 0] > 1 and salts["", 1] > 1
    counted_ = {(r.term, r.fold): r.own for r in own.collect()}
    assert counted_["", 0] + counted_["", 1] == 300


def test_masses_do_not_move_vectors(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs_ = vocabulary.labelled_vectors(spark, small)
        counts = vocabulary.counts(docs_)
        idf = naive_bayes.smooth_idf_table(counts)
        entries = features.real_terms(vocabulary.entries(docs_, "label"))
        shares = features.unit_length(features.tfidf(entries, idf, counts.hot).drop("tf", "idf"))
        plan = shares.groupBy("term").agg(F.sum("tfidf"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("term-vectors") == 1
        for block in plan.split("Exchange hashpartitioning")[1:]:
            assert "vector" not in block.split("+-")[1].split("Generate")[0].split("[")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_new_texts_are_read_once(spark, small):
    docs_ = vocabulary.labelled_vectors(spark, small)
    model = vocabulary.fit_tfidf(docs_, "tfidf")
    texts = spark.read.parquet(f"{small}/benchmark.parquet").select(F.col("item_id").alias("doc_id"), "text")
    plan = vocabulary.score_texts(model, texts)._jdf.queryExecution().executedPlan().toString()
    assert "benchmark.parquet" not in plan  # what is left reads the stored vectors
    assert plan.count("new-vectors") == 1


def test_pairs_are_counted_in_the_row(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "b"])], "doc_id long, words array<string>")
    rows = features.unfold(df, features.term_vector(ngrams(F.col("words"))), ["doc_id"])
    assert {r.term: r.tf for r in rows.collect()} == {"": 1, "a": 2, "b": 2, "a b": 2, "b a": 1}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_unit_counts_store_one_wide_table(spark, monkeypatch):
    """The masses come with the one wide count: no second table of all terms is stored, joined or read again."""
    texts = [(1, 0, "train", "aa bb bb"), (2, 2, "train", "aa cc"), (None, 0, "train", "aa dd"), (3, 0, "train", ""), (1, 2, "test", "aa zz"), (5, 1, "test", "")]
    rows = spark.createDataFrame(texts, "doc_id long, label int, split string, text string")
    docs = vocabulary.stored_vectors(rows)
    train = docs.filter("split = 'train'")
    want = naive_bayes.with_unit_masses(vocabulary.counts(docs), train, vocabulary.entries)
    stored = {}

    def kept(df, name):
        stored[name] = materialise(df, name)
        return stored[name]

    monkeypatch.setattr(naive_bayes, "materialise", kept)
    got = vocabulary.unit_counts(docs)
    assert (got.classes, got.n_docs) == (want.classes, want.n_docs)
    columns = want.table.columns
    by_term = [{r.term: list(r)[1:] for r in c.table.select(columns).collect()} for c in (got, want)]
    assert by_term[0].keys() == by_term[1].keys()
    for term, values in by_term[0].items():
        assert values == pytest.approx(by_term[1][term])
    assert [name for name, table in stored.items() if "zz" in {r.term for r in table.collect() if "term" in table.columns}] == ["masses"]


def test_fold_counts_keep_no_lists(spark):
    """Totals of a term come from a window over its few rows: no list is collected and exploded."""
    rows = [(1, 0, 0, "a", 2), (2, 1, 1, "a", 1), (3, 0, 1, "a", 4), (4, 2, None, "a", 9), (4, 2, None, "b", 1), (1, 0, 0, "c", 3), (5, None, 2, "c", 5)]
    entries = spark.createDataFrame(rows, "doc_id long, label int, fold int, term string, tf int")
    table = crossval.count_by_fold(entries)
    got = {(r.term, r.fold): tuple(r)[2:] for r in table.collect()}
    # first; df and tf of the other folds; the same of all folds
    assert got == {
        ("a", None): (True, 2, 6, 1, 0 - 9, 3, 6, 1, 0),
        ("a", 0): (False, 2, 4, 1, 0, 3, 6, 1, 0),
        ("a", 1): (False, 1, 2, 0, 0, 3, 6, 1, 0),
        ("b", None): (True, -1, 0, 0, -1, 0, 0, 0, 0),
        ("c", 0): (True, 1, 0, 0, 0, 2, 3, 0, 0),
        ("c", 2): (False, 1, 3, 0, 0, 2, 3, 0, 0),
    }
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Generate") == 0


def test_hot_keys_of_a_stored_table_skip_pages(spark, monkeypatch):
    stored = materialise(spark.range(1000).selectExpr("cast(id as string) as term", "id as df"), "counts")
    seen = []
    real = spark.createDataFrame

    def kept(rows, schema):
        seen.append(sorted(tuple(r) for r in rows))
        return real(rows, schema)

    total, parts = 499500, skew.shuffle_partitions(stored)
    plans = []
    collect = type(stored).collect

    def collected(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    spark.createDataFrame = kept
    monkeypatch.setattr(type(stored), "collect", collected)
    try:
        skew.hot_keys(stored, total)
        skew.hot_keys(stored, stored.agg(F.sum("df")).scalar())
        skew.hot_keys(stored, 500 * parts)
    finally:
        del spark.createDataFrame
    limit = total / parts
    assert f"GreaterThan(df,{total // parts})" in plans[0]
    assert seen[0] == seen[1] == sorted((str(n), math.ceil(n / limit)) for n in range(1000) if n > limit)
    assert seen[2] == sorted((str(n), 2) for n in range(501, 1000))
