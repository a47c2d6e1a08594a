"""Sinks for predictions, models and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUN = "run"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", *partitions: str) -> str:
    df.write.mode(mode).partitionBy(*partitions).parquet(path)
    return path


def write_run(df: DataFrame, path: str, run: str, *partitions: str) -> str:
    """Store ``df`` as the run ``run`` of the table at ``path``, dealt to folders by ``partitions``.

    Repeating a run replaces all that its earlier attempt left, and a partition that the repetition no longer
    has goes too. Other runs are not touched, so runs may be written side by side.
    """
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/{RUN}={run}")
    return path


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs, with the run and the partition columns."""
    return spark.read.option("basePath", path).parquet(f"{path}/{RUN}=*")
