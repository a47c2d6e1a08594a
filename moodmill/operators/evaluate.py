"""Classification metrics, all derived from one aggregated row of k x k counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naive_bayes import CLASSES


def accuracy(predictions: DataFrame, *by: str) -> DataFrame:
    """Accuracy as a fraction and in percent, per group of ``by``."""
    hit = F.count_if(F.col("label") == F.col("prediction"))
    counted = predictions.groupBy(*by).agg(F.count("*").alias("n_rows"), hit.alias("n_correct"))
    share = F.col("n_correct") / F.col("n_rows")
    return counted.withColumn("accuracy", share).withColumn("accuracy_pct", 100.0 * share)


def accuracy_of_models(predictions: DataFrame, names: Sequence[str], *by: str) -> DataFrame:
    """The same for every ``<name>_prediction`` column, from one aggregation."""
    hits = [
        F.count_if(F.col("label") == F.col(f"{name}_prediction")).alias(f"hits_{name}")
        for name in names
    ]
    counted = predictions.groupBy(*by).agg(F.count("*").alias("n_rows"), *hits)
    lines = [
        F.struct(F.lit(name).alias("model"), F.col(f"hits_{name}").alias("n_correct"))
        for name in names
    ]
    table = counted.select(*by, "n_rows", F.inline(F.array(*lines)))
    share = F.col("n_correct") / F.col("n_rows")
    return table.withColumn("accuracy", share).withColumn("accuracy_pct", 100.0 * share)


def _cell(actual: int, predicted: int) -> Column:
    return F.col(f"n_{actual}_{predicted}")


def count_cells(predictions: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """A single row with a count for every (actual, predicted) pair, zeros included."""
    return predictions.agg(
        *[
            F.count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"n_{a}_{p}")
            for a in classes
            for p in classes
        ]
    )


def confusion_matrix(predictions: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Rows are actual classes, columns ``predicted_c``, both ascending."""
    lines = [
        F.struct(F.lit(a).alias("label"), *[_cell(a, p).alias(f"predicted_{p}") for p in classes])
        for a in sorted(classes)
    ]
    return count_cells(predictions, classes).select(F.inline(F.array(*lines)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _total(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0])


def per_class_metrics(predictions: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Precision, recall, F1 and support per class; a ratio over nothing is 0."""
    lines = [
        F.struct(
            F.lit(c).alias("label"),
            _cell(c, c).alias("hits"),
            _total([_cell(a, c) for a in classes]).alias("predicted"),
            _total([_cell(c, p) for p in classes]).alias("support"),
        )
        for c in sorted(classes)
    ]
    table = count_cells(predictions, classes).select(F.inline(F.array(*lines)))
    table = table.select(
        "label",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        "support",
    )
    p, r = F.col("precision"), F.col("recall")
    return table.select("label", p, r, _ratio(2.0 * p * r, p + r).alias("f1"), "support")


def weighted_metrics(predictions: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Averages of the class metrics, weighted by the share of the actual class."""
    table = per_class_metrics(predictions, classes)
    weigh = lambda m: _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support"))
    return table.agg(
        weigh("recall").alias("weighted_recall"),
        weigh("precision").alias("weighted_precision"),
        weigh("f1").alias("weighted_f1"),
    )


def classification_report(predictions: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Class lines, then accuracy, macro average and weighted average."""
    table = per_class_metrics(predictions, classes)
    metrics = ["precision", "recall", "f1"]
    lines = table.select(F.col("label").cast("string").alias("line"), *metrics, "support")
    total = F.sum("support")
    by_support = {m: _ratio(F.sum(F.col(m) * F.col("support")), total) for m in metrics}
    # Accuracy is the recall weighted by support.
    averages = table.agg(
        total.alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[by_support[m].alias(f"weighted_{m}") for m in metrics],
    )
    rows = [
        ("accuracy", {m: F.col("weighted_recall") for m in metrics}),
        ("macro avg", {m: F.col(f"macro_{m}") for m in metrics}),
        ("weighted avg", {m: F.col(f"weighted_{m}") for m in metrics}),
    ]
    summary = averages.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("line"),
                        *[value[m].alias(m) for m in metrics],
                        F.col("support"),
                    )
                    for name, value in rows
                ]
            )
        )
    )
    return lines.unionByName(summary)


def auc_from_classes(predictions: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """Area under ROC with the predicted class id as score and label > 0.5 as positive."""
    ordered = sorted(classes)
    positive = [c for c in ordered if c > 0.5]
    negative = [c for c in ordered if c <= 0.5]
    pos = {p: _total([_cell(a, p) for a in positive]) for p in ordered}
    neg = {p: _total([_cell(a, p) for a in negative]) for p in ordered}
    won = F.lit(0.0)
    for i, p in enumerate(ordered):
        below = _total([neg[q] for q in ordered[:i]] + [neg[p] * 0.5])
        won = won + pos[p].cast("double") * below
    pairs = _total(list(pos.values())).cast("double") * _total(list(neg.values()))
    return count_cells(predictions, classes).select(F.try_divide(won, pairs).alias("auc"))
