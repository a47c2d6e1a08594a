"""CSV input and output with explicit string schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..storage import materialise


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    header: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV whose columns are all strings, bound to ``columns`` by position.

    ``multi_line=False`` keeps files splittable, and a quoted line break then
    starts a new record (the label filter removes the fragments).
    ``multi_line=True`` keeps such records whole and reads one file per task, so
    store large inputs as many files.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"' if multi_line else "\\")
        .option("lineSep", "\n")
        .csv(path)
    )


BROKEN = "_broken"


def read_csv_checked(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    required: Sequence[str] = (),
    header: bool = True,
    encoding: str = "UTF-8",
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of a CSV, and the records that do not give one: ``record, reason, file``.

    ``columns`` maps names to types, bound by position; a record is one line. A record is broken if it has too many or
    too few values (``columns``), else by its first column, in their order, whose value is not of the type
    (``type of <name>``) or is missing although ``required`` (``missing <name>``). No record is lost:
    every line is in one of the two results. The file is parsed once and stored.
    """
    fields = [StructField(name, StringType()) for name in (*columns, BROKEN)]
    lines = (
        spark.read.schema(StructType(fields))
        .option("header", header)
        .option("enforceSchema", True)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .csv(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    stored = materialise(lines, "csv-lines")

    def typed(name: str) -> Column:
        return F.col(f"`{name}`").try_cast(columns[name])

    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("columns"))
    for name in columns:
        value = F.col(f"`{name}`")
        reason = reason.when(value.isNotNull() & typed(name).isNull(), F.lit(f"type of {name}"))
        if name in required:
            reason = reason.when(value.isNull(), F.lit(f"missing {name}"))
    judged = stored.withColumn("_reason", reason)
    good = judged.filter("_reason IS NULL").select(*[typed(name).alias(name) for name in columns])
    record = F.coalesce(BROKEN, F.to_csv(F.struct(*[F.col(f"`{name}`") for name in columns])))
    broken = judged.filter("_reason IS NOT NULL").select(
        record.alias("record"), F.col("_reason").alias("reason"), F.col("_file").alias("file")
    )
    return good, broken


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    writer = df.write.option("header", True).option("encoding", encoding)
    writer.option("escape", '"').option("quoteAll", True).option("lineSep", "\n").csv(path)
    return path


def bind_positions(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Select columns by ordinal under new names, whatever the header calls them."""
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(name) for i, name in names.items()])
