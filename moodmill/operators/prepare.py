"""Filters, label encoding, deduplication, replication and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialise

# Class ids of named sentiments and of the numeric labels; every other
# value, null included, is the middle class.
NAMED_LABELS = {"negative": 0, "positive": 2}
NUMERIC_LABELS = {"0": 0, "4": 2}
OTHER_LABEL = 1


def keep_labels(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(allowed)))


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Drop a row with a null in any of ``columns``; plain tests, so the scan gets them."""
    for column in columns or df.columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def encode_label(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, int] = NAMED_LABELS,
    other: int = OTHER_LABEL,
    into: str = "label",
) -> DataFrame:
    value = F.lit(other)
    for name, code in mapping.items():
        value = F.when(F.col(column) == name, code).otherwise(value)
    return df.withColumn(into, value)


def digest(df: DataFrame, column: str) -> Column:
    """What stands for a value in a group: 32 bytes for a text, else the value itself."""
    return F.unhex(F.sha2(column, 256)) if dict(df.dtypes)[column] == "string" else F.col(column)


def least_keys(df: DataFrame, columns: Sequence[str], key: str = "doc_id") -> DataFrame:
    """The least ``key`` of each distinct ``columns``, with ``_group_0``, ``_group_1``, ... in their place.

    A hash aggregation of a number by digests: no text leaves its task, and a text that fills a
    third of the table reaches its reducer as one narrow row per task.
    """
    groups = [digest(df, c).alias(f"_group_{i}") for i, c in enumerate(columns)]
    return df.groupBy(*groups).agg(F.min(key).alias(key))


def keep_least(df: DataFrame, survivors: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df``, which has the same ``_group_i`` columns, that ``least_keys`` chose; nulls are equal.

    Survivors are a stored narrow table, so Spark broadcasts it or shuffles on its measured size.
    """
    groups = [c for c in survivors.columns if c.startswith("_group_")]
    same = [F.col(f"_row.{c}").eqNullSafe(F.col(f"_first.{c}")) for c in (key, *groups)]
    return df.alias("_row").join(survivors.alias("_first"), same, "left_semi").drop(*groups)


def dedup_rows(df: DataFrame, columns: Sequence[str], key: str = "doc_id") -> DataFrame:
    """One row per distinct ``columns``; the one with the smallest ``key`` survives.

    Two phases: digests choose the surviving keys, and a semi-join keeps their rows.
    """
    survivors = materialise(least_keys(df, columns, key), "survivors")
    marked = df.withColumns({f"_group_{i}": digest(df, c) for i, c in enumerate(columns)})
    return keep_least(marked, survivors, key)


def replicate(df: DataFrame, times: int, copy: str = "copy") -> DataFrame:
    """Every row ``times`` times, reading the input once."""
    return df.withColumn(copy, F.explode(F.array(*[F.lit(i) for i in range(times)])))


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_rows"))


#: log2 of the buckets of a distinct-count sketch, and the relative standard error that it gives.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def _per_column(df: DataFrame, totals: DataFrame, *more: str) -> DataFrame:
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("n_rows"),
            F.col(f"present_{i}").alias("n_present"),
            *[F.col(f"{name}_{i}").alias(name) for name in more],
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return totals.select(F.inline(F.array(*lines)))


def _presence(df: DataFrame) -> list[Column]:
    return [F.count("*").alias("n_rows"), *[F.count(F.col(f"`{c}`")).alias(f"present_{i}") for i, c in enumerate(df.columns)]]


def sketch_columns(df: DataFrame) -> DataFrame:
    """One row per column: its type, rows, non-null values and a ``sketch`` of its distinct values.

    One pass over the table, from which each task sends a single row. The result can be stored, and sketches of
    further files merged into it.
    """
    hashed = [F.when(F.col(f"`{c}`").isNotNull(), F.xxhash64(F.col(f"`{c}`"))) for c in df.columns]
    sketches = [F.hll_sketch_agg(h, SKETCH_BITS).alias(f"sketch_{i}") for i, h in enumerate(hashed)]
    return _per_column(df, df.agg(*_presence(df), *sketches), "sketch")


def merge_sketches(*parts: DataFrame) -> DataFrame:
    """The sketches of several sets of rows as those of all of them."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("position", "column_name", "column_type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_present").alias("n_present"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimate_distinct(sketches: DataFrame) -> DataFrame:
    """``n_distinct`` in the place of ``sketch``, with a relative standard error of ``SKETCH_ERROR``."""
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def exact_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_distinct`` by a pass over each column alone, so that no row is repeated per column."""
    counted = None
    for name in columns:
        values = df.select(digest(df, name).alias("value")).filter(F.col("value").isNotNull()).distinct()
        one = values.agg(F.count("*").alias("n_distinct")).select(F.lit(name).alias("column_name"), "n_distinct")
        counted = one if counted is None else counted.unionByName(one)
    return counted


def profile_columns(df: DataFrame, exact: Sequence[str] | None = None) -> DataFrame:
    """One row per column: its type, rows, non-null and distinct values.

    Distinct values are counted exactly for the columns ``exact`` (all, if None) and estimated for the others.
    """
    exact = df.columns if exact is None else list(exact)
    if not exact:
        return estimate_distinct(sketch_columns(df))
    counted = exact_distinct(df, exact)
    if set(exact) == set(df.columns):
        return _per_column(df, df.agg(*_presence(df))).join(counted, "column_name").select(
            "position", "column_name", "column_type", "n_rows", "n_present", "n_distinct"
        )
    estimated = estimate_distinct(sketch_columns(df))
    either = F.coalesce(counted["n_distinct"], estimated["n_distinct"]).alias("n_distinct")
    return estimated.join(counted, "column_name", "left").select(
        "position", "column_name", "column_type", "n_rows", "n_present", either
    )
