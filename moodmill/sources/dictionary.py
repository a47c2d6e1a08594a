"""JSON dictionaries of the form ``{"contractions": {short: long}}``, as a map or as a table.

A map is for dictionaries that fit a task; a table has no such limit.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELD = "contractions"


def read_dictionary(spark: SparkSession, path: str, field: str = FIELD) -> Column:
    """A replacement dictionary as a map column, for use in an expression.

    It is a scalar subquery over the file, which Spark runs once per query and hands to the tasks whole: use
    it for a list that a task can hold, and ``read_dictionary_table`` for any other.
    """
    entries = read_dictionary_table(spark, path, field)
    return entries.agg(F.map_from_entries(F.collect_list(F.struct("short", "long")))).scalar()


def read_dictionary_table(spark: SparkSession, path: str, field: str = FIELD, lines: bool = False) -> DataFrame:
    """``short, long``, one row per entry; of entries with the same ``short`` the greatest ``long``.

    ``lines=False`` reads files that are one object each, which a single task parses. With ``lines`` each line
    is an object with some of the entries, so that a file is read by many tasks.
    """
    table = spark.read.schema(f"`{field}` map<string,string>").option("multiLine", not lines).json(path)
    return table.select(F.explode(field).alias("short", "long")).groupBy("short").agg(F.max("long").alias("long"))


def write_dictionary_table(entries: DataFrame, path: str, field: str = FIELD) -> str:
    """Store ``short, long`` rows with one object per line, from every task."""
    line = F.to_json(F.struct(F.create_map("short", "long").alias(field)))
    entries.select(line.alias("value")).write.text(path)
    return path


def write_dictionary(spark: SparkSession, path: str, entries: Mapping[str, str], field: str = FIELD) -> str:
    """Store a dictionary in that form, through Spark's own writer."""
    line = json.dumps({field: dict(entries)}, ensure_ascii=False)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(path)
    return path
