"""k-fold cross-validation in one pass: training counts are totals less the fold's own."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise
from .features import real_terms
from .naive_bayes import CLASSES, _extra_term, best_class
from .skew import hot_keys, join_per_term


def count_by_fold(entries: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """One row per term and fold that holds it: counts of the other folds and of all folds.

    ``df, tf_c`` count the documents of the other folds, ``all_df, all_tf_c`` those of every
    fold, and ``first`` marks one row of each term. Only pairs that occur are stored: a
    document of a fold can only ask for terms that its fold holds. Rows with a null fold stand
    for terms of documents outside the folds.
    """
    own = [F.count("*").alias("own_df")]
    for c in classes:
        mine = F.sum(F.when(F.col("label") == c, F.col("tf")))
        own.append(F.coalesce(mine, F.lit(0)).alias(f"own_tf_{c}"))
    counted = entries.groupBy("term", "fold").agg(*own)

    # A term has at most one row per fold and one outside, so its window is short; these rows move to their term once.
    names = ["df", *[f"tf_{c}" for c in classes]]
    term = Window.partitionBy("term").orderBy("fold")
    every = term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = F.col("fold").isNotNull()
    totals = [
        F.coalesce(F.sum(F.when(inside, F.col(f"own_{n}"))).over(every), F.lit(0)).alias(f"all_{n}") for n in names
    ]
    rows = counted.select("*", *totals, (F.row_number().over(term) == 1).alias("first"))
    others = [(F.col(f"all_{n}") - F.col(f"own_{n}")).alias(n) for n in names]
    return rows.select("term", "fold", "first", *others, *[f"all_{n}" for n in names])


def cross_validate(
    entries: DataFrame,
    k: int,
    tfidf: bool,
    vocabulary_size: int | None = None,
    classes: Sequence[int] = CLASSES,
    alpha: float = 1.0,
    training_vocabulary: bool = False,
) -> DataFrame:
    """``doc_id, label, fold, prediction`` with each document scored by the other folds.

    ``entries`` has ``doc_id, label, fold, term, tf``; documents with a null fold only add
    their terms to the vocabulary, whose size is counted unless given. With ``tfidf`` the
    IDF is refitted for every fold and the prior is smoothed; otherwise raw counts and a
    plain prior.

    With ``training_vocabulary`` the vocabulary too is refitted: that of a fold's model is what the other folds
    hold, its size is the size of all less the terms that only this fold holds, and a term outside it is
    left out of the score. The terms of all folds are still counted in one pass.
    """
    table = materialise(count_by_fold(entries, classes), "fold-counts")
    inside = table.filter(F.col("fold").isNotNull())
    # At most k rows: the class sizes outside each fold.
    sizes = {r.fold: r for r in inside.filter(F.col("term") == _extra_term(table)).collect()}
    folds = sorted(sizes)
    n_docs = {(f, c): sizes[f][f"tf_{c}"] for f in folds for c in classes}
    n_train = {f: sizes[f]["df"] for f in folds}

    def per_fold(values: dict[int, float | None]) -> Column:
        return F.get(F.array(*[F.lit(values.get(f)).cast("double") for f in range(k)]), F.col("fold"))

    def idf(df: Column) -> Column:
        if not tfidf:
            return F.lit(1.0)
        return F.log(per_fold({f: n + 1.0 for f, n in n_train.items()}) / (df + 1.0))

    # A term that a fold does not hold weighs in it as it does over all folds. So the mass of a
    # class outside a fold is a sum over all terms, corrected for the terms of the fold.
    terms, pairs = real_terms(table), real_terms(inside)
    over_all = [F.count("*").alias("n_terms"), F.count_if(F.col("all_df") > 0).alias("n_inside")]
    corrections = [F.count_if(F.col("df") == 0).alias("exclusive")]
    for c in classes:
        whole = F.col(f"all_tf_{c}")
        over_all.append(F.sum(whole).alias(f"t_{c}"))
        over_all.append(F.sum(F.log(F.col("all_df") + 1.0) * whole).alias(f"l_{c}"))
        change = idf(F.col("df")) * F.col(f"tf_{c}") - idf(F.col("all_df")) * whole
        corrections.append(F.sum(change).alias(f"b_{c}"))
    totals = terms.filter("first").agg(*over_all).first()
    by_fold = {r.fold: r for r in pairs.groupBy("fold").agg(*corrections).collect()}
    if vocabulary_size is None:
        vocabulary_size = totals["n_terms"]
    sizes_of = dict.fromkeys(folds, vocabulary_size)
    if training_vocabulary:
        sizes_of = {f: totals["n_inside"] - (by_fold[f]["exclusive"] if f in by_fold else 0) for f in folds}

    smoothing = alpha if tfidf else 0.0
    bias: dict[int, dict[int, float | None]] = {c: {} for c in classes}
    unit: dict[int, dict[int, float]] = {c: {} for c in classes}
    for f in folds:
        present = [c for c in classes if n_docs[f, c]]
        total = n_train[f] + smoothing * len(present)
        for c in classes:
            bias[c][f] = math.log((n_docs[f, c] + smoothing) / total) if c in present else None
            mass = totals[f"t_{c}"] or 0.0
            if tfidf:
                mass = math.log(n_train[f] + 1.0) * mass - (totals[f"l_{c}"] or 0.0)
            mass += by_fold[f][f"b_{c}"] if f in by_fold else 0.0
            unit[c][f] = math.log(alpha / (mass + alpha * max(sizes_of[f], 1)))

    # The extra entry is a key too: every document of a fold carries it.
    own = inside.select("term", "fold", (F.col("all_df") - F.col("df")).alias("own"))
    n_entries = own.agg(F.sum("own")).first()[0]
    hot = hot_keys(own, n_entries or 0, ("term", "fold"), "own")
    weights = pairs.select(
        "term",
        "fold",
        F.when(F.lit(not training_vocabulary) | (F.col("df") > 0), idf(F.col("df"))).alias("idf"),
        *[F.log1p(idf(F.col("df")) * F.col(f"tf_{c}") / alpha).alias(f"w_{c}") for c in classes],
    )
    scored = entries.filter(F.col("fold").isNotNull())
    joined = join_per_term(scored, weights, hot, on=("term", "fold"))
    x = F.coalesce(F.col("tf") * F.col("idf"), F.lit(0.0))
    valued = joined.select("doc_id", "label", "fold", x.alias("x"), *[f"w_{c}" for c in classes])
    per_doc = valued.groupBy("doc_id", "label", "fold").agg(
        F.sum("x").alias("x"),
        *[
            F.sum(F.col("x") * F.coalesce(f"w_{c}", F.lit(0.0))).alias(f"sum_{c}")
            for c in classes
        ],
    )
    scores = [
        (per_fold(bias[c]) + per_fold(unit[c]) * F.col("x") + F.col(f"sum_{c}")).alias(f"score_{c}")
        for c in classes
    ]
    ranked = best_class(per_doc.select("doc_id", "label", "fold", *scores), classes)
    return ranked.select("doc_id", "label", "fold", "prediction")


def vocabulary_sizes(entries: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """``fold``, the terms that only this fold holds, and the size of the vocabulary without it.

    One count over (term, fold) pairs: a term is exclusive to a fold if no other document has it, so no
    fold needs a pass of its own.
    """
    table = materialise(count_by_fold(entries, classes), "fold-counts")
    inside = real_terms(table).filter(F.col("fold").isNotNull())
    exclusive = inside.groupBy("fold").agg(F.count_if(F.col("df") == 0).alias("n_exclusive"))
    # One row of each term is marked, inside the folds or outside.
    n_all = real_terms(table).agg(F.count_if(F.col("first") & (F.col("all_df") > 0)).alias("n_all")).scalar()
    return exclusive.select("fold", "n_exclusive", (n_all - F.col("n_exclusive")).alias("n_terms"))


def fold_accuracy(predictions: DataFrame) -> DataFrame:
    """One row per fold: documents, hits and accuracy."""
    hit = F.count_if(F.col("label") == F.col("prediction"))
    return (
        predictions.groupBy("fold")
        .agg(F.count("*").alias("n_rows"), hit.alias("n_correct"))
        .withColumn("accuracy", F.col("n_correct") / F.col("n_rows"))
    )


def summarise_folds(accuracies: DataFrame) -> DataFrame:
    """Mean and population standard deviation over the folds."""
    return accuracies.agg(
        F.count("*").alias("k"),
        F.avg("accuracy").alias("mean_accuracy"),
        F.stddev_pop("accuracy").alias("std_accuracy"),
    )
