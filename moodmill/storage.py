"""Shared storage: where fitted tables are written so that later stages read them back.

A written table cuts the lineage, survives lost executors and gives the
optimizer the real size of the table, so that Spark's own broadcast threshold
decides on a measured number.

Stored tables live until ``removing_tables`` ends, or for good outside of it: a result is lazy, so only
its caller knows when it has been written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("_open_scopes", default=())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="moodmill-"))
        folder = context.getCheckpointDir()
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/moodmill/{name}-{uuid.uuid4().hex}"
    for scope in _open_scopes.get():
        scope.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` to its end."""
    files, place = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The ``n`` of all complete tables ``path/name=n``, in order."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    found = [status.getPath().getName() for status in files.listStatus(place)]
    numbers = sorted(int(f.removeprefix(f"{name}=")) for f in found if f.startswith(f"{name}="))
    return [n for n in numbers if is_complete(spark, f"{path}/{name}={n}")]


@contextmanager
def removing_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that were stored inside, once the results that need them are written.

    They are removed through the file system of the folder, whichever it is.
    """
    paths: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), paths))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in paths:
            files, place = _file_system(spark, path)
            files.delete(place, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return the stored table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
