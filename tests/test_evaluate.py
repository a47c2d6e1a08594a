import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from moodmill.operators import evaluate, ranking


@pytest.fixture(scope="module")
def predictions(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 1, 2, 2, 2]), rng.choice([0, 1, 2, 2])) for _ in range(211)]
    return spark.createDataFrame(rows, "label int, prediction int")


def test_weighted_metrics_equal_ml(predictions):
    as_double = predictions.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    mine = evaluate.weighted_metrics(predictions).first()
    for metric, value in [
        ("weightedRecall", mine.weighted_recall),
        ("weightedPrecision", mine.weighted_precision),
        ("f1", mine.weighted_f1),
        ("accuracy", mine.weighted_recall),
    ]:
        ml = MulticlassClassificationEvaluator(metricName=metric).evaluate(as_double)
        assert value == pytest.approx(ml)


def test_per_class_metrics_equal_ml(predictions):
    as_double = predictions.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for r in evaluate.per_class_metrics(predictions).collect():
        for metric, value in [("precisionByLabel", r.precision), ("recallByLabel", r.recall), ("fMeasureByLabel", r.f1)]:
            ml = MulticlassClassificationEvaluator(metricName=metric, metricLabel=float(r.label))
            assert value == pytest.approx(ml.evaluate(as_double))


def test_auc_equals_ml(predictions):
    binary = predictions.select(
        (F.col("label") > 0).cast("double").alias("label"), F.col("prediction").cast("double").alias("raw")
    )
    ml = BinaryClassificationEvaluator(rawPredictionCol="raw").evaluate(binary)
    assert evaluate.auc_from_classes(predictions).first().auc == pytest.approx(ml)


def test_confusion_matrix_sums_and_zeros(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 2)], "label int, prediction int")
    rows = [tuple(r) for r in evaluate.confusion_matrix(df).collect()]
    assert rows == [(0, 1, 0, 1), (1, 0, 0, 0), (2, 0, 0, 1)]


def test_missing_class_scores_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    r = evaluate.per_class_metrics(df).filter("label = 1").first()
    assert (r.precision, r.recall, r.f1, r.support) == (0.0, 0.0, 0.0, 0)
    assert evaluate.auc_from_classes(df).first().auc is None


def test_report_lines(predictions):
    rows = {r.line: r for r in evaluate.classification_report(predictions).collect()}
    assert list(rows) == ["0", "1", "2", "accuracy", "macro avg", "weighted avg"]
    assert rows["accuracy"].f1 == pytest.approx(rows["weighted avg"].recall)
    assert rows["macro avg"].precision == pytest.approx(sum(rows[c].precision for c in "012") / 3)
    assert rows["accuracy"].support == 211


def ranked(spark, seed, n, values):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.choice(values) + rng.choice([0.0, 0.25]), rng.random() < 0.3) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "g string, score double, positive boolean")


@pytest.mark.parametrize("values", [[0.0], [float(i) / 7 for i in range(-400, 400)]])  # nearly all tied; many ranges
def test_auc_of_scores_equals_ml(spark, values):
    rows, df = ranked(spark, 3, 3000, values)
    got = {r.g: r for r in ranking.auc(df, ["g"]).collect()}
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    for g in "ab":
        part = df.filter(F.col("g") == g).select("score", F.col("positive").cast("double").alias("label"))
        assert got[g].auc == pytest.approx(ml.evaluate(part))
        assert got[g].n_positive == sum(p for h, _, p in rows if h == g)


def test_auc_counts_rows_below_over_all_ranges(spark):
    _, df = ranked(spark, 4, 2000, [float(i) / 3 for i in range(500)])
    placed = sorted(ranking.placed_counts(df).collect(), key=lambda r: r.score)
    below = 0
    for r in placed:
        assert r.neg_below == below
        below += r.neg
    assert len({r.score for r in placed}) == len(placed)


def test_auc_with_one_class_or_no_rows(spark):
    one = spark.createDataFrame([("a", 1.0, True), ("a", None, False), ("a", 2.0, None)], "g string, score double, positive boolean")
    assert [tuple(r) for r in ranking.auc(one, ["g"]).collect()] == [("a", 1, 0, None)]
    assert [r.auc for r in ranking.auc(one.filter("false")).collect()] == [None]


def test_no_window_over_all_scores(spark):
    _, df = ranked(spark, 5, 100, [1.0, 2.0])
    plan = ranking.auc(df)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    under = [below for line, below in zip(lines, lines[1:]) if "SinglePartition" in line]
    # Single partitions hold one line per range or one per task, never the scores.
    assert not any("score#" in below for below in under)
