"""Column expressions for words that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that separate words: space and the control characters 0x09 to 0x0D.
BREAKS = " \t\n\x0b\x0c\r"
BREAK_RUN = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text in order; an empty array for a null text or one without words."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BREAK_RUN))


def word_count(text: Column) -> Column:
    """How many words a text has, without building them; 0 for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, BREAK_RUN))).cast("long")


def filter_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition on computed columns, without computing these twice.

    Spark would copy the columns' expressions into a filter below them; it does not move a filter
    that also reads a column that is different for every row.
    """
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    return numbered.filter(condition & (F.col("_at") >= 0)).drop("_at")
