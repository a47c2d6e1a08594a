from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodmill.operators import prepare, splits


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(5000).select(F.col("id").alias("doc_id"))


def test_dedup_keeps_case_and_label_variants(spark):
    rows = [(5, "positive", "Hi"), (2, "positive", "Hi"), (3, "negative", "Hi"), (4, "positive", "hi")]
    df = spark.createDataFrame(rows, "doc_id long, sentiment string, text string")
    kept = prepare.dedup_rows(df, ["sentiment", "text"]).orderBy("doc_id").collect()
    assert [r.doc_id for r in kept] == [2, 3, 4]


def test_dedup_treats_nulls_as_equal_and_keeps_a_null_key(spark):
    rows = [(1, None, "x"), (2, None, "x"), (3, "a", None), (4, "a", None), (None, "b", "x"), (5, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, sentiment string, text string")
    kept = prepare.dedup_rows(df, ["sentiment", "text"]).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [1, 3, 5, None]


def test_dedup_with_a_third_of_all_rows_equal(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"),
    )
    assert prepare.dedup_rows(df, ["text"]).count() == 2001


def test_labels_and_nulls(spark):
    df = spark.createDataFrame([("0",), ("2",), ("4",), (None,)], "sentiment string")
    coded = prepare.encode_label(df, "sentiment", prepare.NUMERIC_LABELS)
    assert [r.label for r in coded.collect()] == [0, 1, 2, 1]
    assert prepare.keep_labels(df, "sentiment", ["0", "4"]).count() == 2
    assert prepare.drop_nulls(df).count() == 3


def test_replicate_reads_once(spark):
    df = prepare.replicate(spark.range(10), 8)
    assert df.count() == 80
    assert df.select("id", "copy").distinct().count() == 80


def test_weighted_split_shares(keys):
    parts = splits.weighted_split(keys, (0.1, 0.025, 0.875), seed=1)
    sizes = Counter(r.part for r in parts.collect())
    assert abs(sizes[0] / 5000 - 0.1) < 0.02 and abs(sizes[1] / 5000 - 0.025) < 0.01
    assert sum(sizes.values()) == 5000
    zero = splits.weighted_split(keys, (0.7, 0.3, 0.0), seed=1)
    assert {r.part for r in zero.select("part").distinct().collect()} == {0, 1}


def test_splits_do_not_depend_on_partitions(keys):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    for change in (
        splits.train_test,
        lambda df: splits.folds(df, 7),
        lambda df: splits.weighted_split(df, (1, 2), 9),
        lambda df: splits.exact_split(df, (3, 10), 10, 69),
    ):
        assert rows(change(keys)) == rows(change(keys.repartition(13, "doc_id")))


def test_exact_split_sizes(keys):
    rows = splits.exact_split(keys.limit(4999), (3, 10), 10, seed=69).collect()
    assert Counter(r.split for r in rows) == {"test": 1500, "train": 3499}
    assert sorted(Counter(r.fold for r in rows).values()) == [499] + [500] * 9


def test_shuffled_rank_is_a_permutation(keys):
    ranks = [r["rank"] for r in splits.shuffled_rank(keys, 5).collect()]
    assert sorted(ranks) == list(range(5000))


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "id long, t string")
    rows = {r.column_name: r for r in prepare.profile_columns(df).collect()}
    assert (rows["t"].n_rows, rows["t"].n_present, rows["t"].n_distinct) == (3, 2, 1)
    assert rows["id"].column_type == "bigint"


def test_profile_without_repeating_rows(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    plan = prepare.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan


def test_profile_of_asked_columns_and_odd_values(spark):
    rows = [(i % 7, None if i % 3 else float(i), ["a"] * (i % 2), f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, `x y` double, list array<string>, t string")
    got = {r.column_name: r for r in prepare.profile_columns(df, exact=["k"]).collect()}
    assert (got["k"].n_distinct, got["x y"].n_present, got["list"].n_distinct) == (7, 1000, 2)
    assert abs(got["t"].n_distinct - 3000) < 4 * prepare.SKETCH_ERROR * 3000
    assert [r.n_distinct for r in prepare.profile_columns(df.filter("false")).orderBy("position").collect()] == [0] * 4


def test_merged_sketches_are_those_of_all_rows(spark):
    df = spark.range(5000).select(F.col("id") % 1237, F.concat(F.lit("v"), "id").alias("v"))
    whole = prepare.estimate_distinct(prepare.sketch_columns(df))
    parts = [prepare.sketch_columns(df.filter(F.col("v").endswith(str(i)))) for i in range(10)]
    merged = prepare.estimate_distinct(prepare.merge_sketches(*parts))
    as_rows = lambda d: sorted(tuple(r) for r in d.select(*whole.columns).collect())
    assert as_rows(merged) == as_rows(whole)
