"""Join of the long term table with a table that has one row per term."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(stats: DataFrame, total: int | Column, on: Sequence[str] = ("term",), order: str = "df") -> DataFrame:
    """``on`` columns and ``salts`` of the keys that outweigh an average shuffle partition.

    ``stats`` has one row per key with its entries in ``order``, and ``total`` entries in all. A key
    with more than ``total / partitions`` of them gets as many salts as it fills partitions. Fewer
    keys than partitions can be that frequent, and all salts together are at most twice the
    partitions, so the list is short whatever the data. It only decides how rows travel.
    """
    partitions = shuffle_partitions(stats)
    limit = F.greatest(F.lit(1), total if isinstance(total, Column) else F.lit(total)) / partitions
    share = F.col(order) / limit
    # Whole numbers compare with a whole limit, so a stored table is read only where such a key is.
    least = F.floor(limit) if isinstance(total, Column) else F.lit(max(1, total) // partitions).cast("bigint")
    found = stats.filter(F.col(order) > least).select(*on, F.ceil(share).cast("int").alias("salts"))
    # Held in the plan, so that using the list twice costs nothing.
    return stats.sparkSession.createDataFrame(found.collect(), found.schema)


def count_hot_keys(entries: DataFrame, on: Sequence[str] = ("term",)) -> DataFrame:
    """The same list for entries that nothing has counted yet."""
    stats = entries.groupBy(*on).agg(F.count("*").alias("df"))
    # The number of entries is the sum of these counts, whose exchange Spark reuses: the entries are read once.
    return hot_keys(stats, stats.agg(F.coalesce(F.sum("df"), F.lit(0))).scalar(), on)


def join_per_term(
    entries: DataFrame,
    table: DataFrame,
    hot: DataFrame,
    how: str = "left",
    spread_by: str = "doc_id",
    on: Sequence[str] = ("term",),
) -> DataFrame:
    """``entries`` joined with ``table``, which is unique on ``on`` (``term`` first).

    A hot key gets ``salts`` keys: its entries are dealt over these by document, and its single
    table row is repeated for each. Whether the table is broadcast or both sides are shuffled is
    left to Spark, which knows the measured size of a stored table.
    """
    keys = list(on)
    # Fewer rows than shuffle partitions.
    marked = F.broadcast(hot)
    own = F.pmod(F.xxhash64(spread_by), F.col("salts")).cast("int")
    left = entries.join(marked, keys, "left")
    left = left.withColumn("_salt", F.coalesce(own, F.lit(0))).drop("salts")
    every = F.sequence(F.lit(0), _salts(hot, keys) - 1)
    right = table.withColumn("_salt", F.explode(every))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def _salts(hot: DataFrame, keys: Sequence[str]) -> Column:
    """The salts of a row of the table, as an expression: after a join the optimizer would not know the table's size."""
    kinds = [hot.schema[k].dataType for k in keys]
    rows = [row for row in hot.select(*keys, "salts").collect() if None not in row]
    if not rows:
        return F.lit(1)
    lines = []
    for *values, salts in rows:
        key = [F.lit(v).cast(kind).alias(k) for v, kind, k in zip(values, kinds, keys, strict=True)]
        lines += [F.struct(*key), F.lit(salts)]
    listed = F.create_map(*lines)[F.struct(*[F.col(k) for k in keys])]
    # Most rows end at the first test, a look-up in a set.
    return F.when(F.col(keys[0]).isin(list({row[0] for row in rows})), F.coalesce(listed, F.lit(1))).otherwise(1)
