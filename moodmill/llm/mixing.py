"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

1. *Targets.* Sources in code point order (null last) carry the repeating ``weights`` and share
   ``share`` times all words. A source stops at ``cap`` times its own words and the excess goes to
   the others by weight. With sources ordered by cap per weight, the level of this water-filling
   is the largest of the levels left after each prefix of full sources, so windows over the
   source table replace the repeated resharing.
2. *Stream.* A source is read in the order of a hash of the key, round after round, until its
   target is met; the last document is cut. The place of a document is the sum of the buckets
   before its own plus a running sum inside its bucket, so a source with a third of all rows is
   spread over ``buckets`` groups.
3. *Positions.* A source's weight over training time is piecewise linear. Its integral, scaled to
   the target, is the demand for its words; inverting it at the place where a document starts
   gives the training time of the document. Documents are range-sorted by that time.

Defined results: a null text has size 0; a null source is one source, last in order; repeated
rows are separate documents; an empty table gives an empty table; a document of size 0 takes
nothing and has no position. Ties in the hash go by key, then size; rows equal in all three are
interchangeable. A very long text counts by all its words; other columns, whatever their names, are passed on as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.storage import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
#: Groups that the documents of one source are spread over.
BUCKETS = 4096

#: Weight at points of training time (0 to 1), linear in between; repeats like the weights.
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
    ((0.0, 1.5), (0.75, 0.5), (1.0, 0.5)),
)

Schedule = Sequence[tuple[float, float]]


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """``(t0, a0, a1, w0, slope)`` per stretch, with the whole integral scaled to 1."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        part = (t1 - t0) * (w0 + w1) / 2 / area
        out.append((t0, done, done + part, w0 / area, (w1 - w0) / (t1 - t0) / area))
        done += part
    return out


def training_time(share: Column, schedule: Schedule) -> Column:
    """The time at which the integrated schedule reaches ``share`` (0 to 1) of its whole."""
    parts = segments(schedule)
    time = None
    for t0, a0, a1, w0, slope in reversed(parts):
        rest = F.greatest(share - a0, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2.0 * slope * rest, F.lit(0.0)))
        here = F.when(rest <= 0.0, F.lit(t0)).otherwise(t0 + 2.0 * rest / (w0 + root))
        time = here if time is None else F.when(share < a1, here).otherwise(time)
    return time


def _stream(docs: DataFrame, key: str, source: str, size: Column, keep: Sequence[str], buckets: int) -> DataFrame:
    text_key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digest = F.md5(text_key)
    return docs.select(
        *(F.col(c) for c in keep),
        F.col(key).alias("_id"),
        F.col(source).alias("_source"),
        F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source))).alias("_key"),
        size.cast("long").alias("size"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("_hash"),
    ).withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(buckets)).cast("int"))


def _targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """One row per source with its size, its target and the number of its schedule."""
    in_order = Window.orderBy(F.col("_source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sizes.withColumn("_turn", F.row_number().over(in_order) - 1)
    table = F.array(*(F.lit(float(w)) for w in weights))
    weighed = ranked.select(
        "_key",
        "source_size",
        "_turn",
        F.get(table, F.col("_turn") % len(weights)).alias("_weight"),
        (cap * F.col("source_size")).alias("_cap"),
        (share * F.sum("source_size").over(everything)).alias("_all"),
    )
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_turn")
    left = F.col("_all") - F.coalesce(
        F.sum("_cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    open_weight = F.sum("_weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    levelled = weighed.withColumn("_level", left / open_weight)
    level = F.max("_level").over(everything)
    return levelled.select(
        "_key",
        "source_size",
        "_turn",
        F.least(F.col("_cap"), level * F.col("_weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    keep: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    schedules: Sequence[Schedule] = SCHEDULES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``keep`` columns, size, source_size, target, taken and the start places of both rounds."""
    stream = _stream(docs, key, source, size, keep, buckets)
    # One narrow table of counts; texts are not part of it.
    counts = materialise(
        stream.groupBy("_key", "_source", "_bucket").agg(F.sum("size").alias("_bucket_size")), "mix-buckets"
    )
    sizes = counts.groupBy("_key", "_source").agg(F.sum("_bucket_size").alias("source_size"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.select(
        "_key",
        "_bucket",
        F.coalesce(F.sum("_bucket_size").over(before), F.lit(0)).alias("_base"),
    ).join(_targets(sizes, weights, share, cap), "_key")
    inside = (
        Window.partitionBy("_key", "_bucket")
        .orderBy("_hash", "_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = stream.join(places, ["_key", "_bucket"]).withColumn(
        "_at", F.col("_base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    words = F.floor(F.col("target") + 0.5).cast("long")
    zero = F.lit(0).cast("long")

    def met(start: Column) -> Column:
        return F.greatest(zero, F.least(F.col("size"), words - start))

    again = F.col("_at") + F.col("source_size")
    return placed.select(
        *(F.col(c) for c in keep),
        "size",
        "source_size",
        "target",
        (met(F.col("_at")) + met(again)).alias("taken"),
        met(F.col("_at")).alias("taken_first"),
        met(again).alias("taken_again"),
        _position(F.col("_at"), met(F.col("_at")), schedules).alias("position"),
        _position(again, met(again), schedules).alias("position_again"),
    )


def _position(start: Column, taken: Column, schedules: Sequence[Schedule]) -> Column:
    """Training time of a copy that starts at word ``start`` of its source; null if none is taken."""
    share = start / F.col("target")
    turn = F.col("_turn") % len(schedules)
    time = training_time(share, schedules[0])
    for number, schedule in list(enumerate(schedules))[1:]:
        time = F.when(turn == number, training_time(share, schedule)).otherwise(time)
    return F.when(taken > 0, time)


def sequence_by_position(mixed: DataFrame, *keys: str) -> DataFrame:
    """Documents in training order; those without a position last, spread by the keys."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), *keys)


def curriculum(docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mixed documents themselves, a row per copy, with the columns of ``docs``, by position.

    A copy is given whole if at least half of it is taken, else left out.
    """
    whole = docs.select(
        F.struct("*").alias("_row"), F.col(key).alias("_k"), F.col(source).alias("_s"), size.alias("_n")
    )
    mixed = mix(whole, F.col("_n"), key="_k", source="_s", keep=("_row",), **options)
    copies = F.filter(
        F.array(
            F.struct(F.col("position").alias("at"), F.col("taken_first").alias("n")),
            F.struct(F.col("position_again").alias("at"), F.col("taken_again").alias("n")),
        ),
        lambda c: (c["n"] > 0) & (2 * c["n"] >= F.col("size")),
    )
    return (
        mixed.select("_row", F.explode(copies).alias("_copy"))
        .orderBy("_copy.at")
        .select("_row.*")
    )
