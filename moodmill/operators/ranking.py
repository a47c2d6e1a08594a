"""Ranks of real-valued scores over the whole table, and the area under ROC that they give.

No window spans all rows: rows of equal score are merged first, the merged rows are dealt to ranges of the score,
ranks are counted inside a range, and a table with one line per range says how many rows lie below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise

#: Digits to which scores are compared. The order in which a sum was added up shows far below that.
SCORE_DIGITS = 6


def log_odds(label: int, classes: Sequence[int], score: str = "score_{}") -> Column:
    """The log of the chance of a class against all others, from log-scores up to a common constant."""
    others = [F.col(score.format(c)) for c in classes if c != label]
    most = F.greatest(*others) if len(others) > 1 else others[0]
    total = sum((F.exp(x - most) for x in others[1:]), F.exp(others[0] - most))
    return F.col(score.format(label)) - (most + F.log(total))


def placed_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``score``, counts ``pos`` and ``neg`` of each distinct score, and ``neg_below`` it.

    ``scored`` has ``by``, ``score`` and the boolean ``positive``; rows without a score or a class are left out. A score that a
    third of all rows share is one row per task before it travels. Ranges are stored before they are used twice, since
    their bounds come from a sample.
    """
    known = scored.filter(F.col("score").isNotNull() & F.col("positive").isNotNull())
    merged = known.groupBy(*by, F.round("score", SCORE_DIGITS).alias("score")).agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg")
    )
    ranged = merged.repartitionByRange(*by, "score").withColumn("part", F.spark_partition_id())
    stored = materialise(ranged, "score-ranges")
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy(*by, "part").agg(F.sum("neg").alias("inside"))
    # At most one line per range and group: few, whatever the data.
    below = sizes.select(*by, "part", F.coalesce(F.sum("inside").over(before(*by).orderBy("part")), F.lit(0)).alias("below"))
    earlier = F.coalesce(F.sum("neg").over(before("part", *by).orderBy("score")), F.lit(0))
    counted = stored.withColumn("earlier", earlier).join(F.broadcast(below), [*by, "part"])
    return counted.select(*by, "score", "pos", "neg", (F.col("below") + F.col("earlier")).alias("neg_below"))


def auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n_positive``, ``n_negative`` and ``auc``: the share of pairs in order, equal scores counting half.

    A group without positive or without negative rows has a null ``auc``.
    """
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + 0.5 * F.col("neg")))
    totals = placed_counts(scored, by).groupBy(*by).agg(
        F.sum("pos").alias("n_positive"), F.sum("neg").alias("n_negative"), won.alias("won")
    )
    pairs = F.col("n_positive").cast("double") * F.col("n_negative")
    return totals.select(*by, "n_positive", "n_negative", F.try_divide("won", pairs).alias("auc"))


def one_vs_rest(predictions: DataFrame, classes: Sequence[int]) -> DataFrame:
    """``label, score, positive``: every prediction once per class, with the class's log-odds."""
    lines = [
        F.struct(
            F.lit(c).alias("label"), log_odds(c, classes).alias("score"), (F.col("label") == c).alias("positive")
        )
        for c in classes
    ]
    return predictions.select(F.inline(F.array(*lines)))
