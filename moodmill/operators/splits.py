"""Random splits and folds keyed by a hash, stable under retries and repartitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH_RANGE, hash32

RANK_BUCKETS = 1 << 16


def seeded_key(key: str, seed: int) -> Column:
    return F.concat_ws(":", F.lit(seed), F.col(key))


def weighted_split(
    df: DataFrame, weights: Sequence[float], seed: int, key: str = "doc_id", into: str = "part"
) -> DataFrame:
    """Number the rows' parts 0, 1, ... with probabilities in proportion to ``weights``."""
    total = float(sum(weights))
    reached, value = 0.0, F.lit(len(weights) - 1)
    bounds = []
    for weight in weights:
        reached += weight
        bounds.append(round(reached / total * HASH_RANGE))
    last = max(i for i, weight in enumerate(weights) if weight > 0)
    value = F.lit(last)
    for i in reversed(range(last)):
        value = F.when(hash32(seeded_key(key, seed)) < bounds[i], i).otherwise(value)
    return df.withColumn(into, value)


def train_test(df: DataFrame, test_tenths: int = 3, key: str = "doc_id") -> DataFrame:
    """Add ``split``: the hash of the key modulo ten decides, without a shuffle."""
    part = hash32(F.col(key)) % 10
    return df.withColumn("split", F.when(part < 10 - test_tenths, "train").otherwise("test"))


def folds(df: DataFrame, k: int, key: str = "doc_id") -> DataFrame:
    """Add ``fold`` in ``0 .. k-1``; higher digits of the hash, so independent of the split."""
    return df.withColumn("fold", (F.floor(hash32(F.col(key)) / 10) % k).cast("int"))


def shuffled_rank(df: DataFrame, seed: int, key: str = "doc_id", into: str = "rank") -> DataFrame:
    """Rank of each row in one global shuffled order, starting at 0.

    Rows are ranked inside 65,536 equal slices of the hash range, and the rows before
    each slice come from a table with one line per slice.
    """
    slice_width = HASH_RANGE // RANK_BUCKETS
    hashed = df.withColumn("_hash", hash32(seeded_key(key, seed)))
    hashed = hashed.withColumn("_slice", F.floor(F.col("_hash") / slice_width).cast("int"))
    sizes = hashed.groupBy("_slice").agg(F.count("*").alias("_size"))
    # At most RANK_BUCKETS lines: one task sums them and every task can hold them.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy("_hash", key))
    ranked = hashed.withColumn("_inside", inside).join(F.broadcast(offsets), "_slice")
    rank = F.col("_before") + F.col("_inside") - 1
    return ranked.withColumn(into, rank).drop("_hash", "_slice", "_inside", "_before")


def exact_split(
    df: DataFrame, test_share: tuple[int, int], k: int, seed: int, key: str = "doc_id"
) -> DataFrame:
    """``split`` with ``ceil(n * a / b)`` test rows, and ``fold`` with sizes that differ by one."""
    n = df.count()
    numerator, denominator = test_share
    n_test = -(-n * numerator // denominator)
    ranked = shuffled_rank(df, seed, key)
    return ranked.select(
        *df.columns,
        F.when(F.col("rank") < n_test, "test").otherwise("train").alias("split"),
        (F.col("rank") % k).cast("int").alias("fold"),
    )
