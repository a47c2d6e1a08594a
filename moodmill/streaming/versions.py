"""Versioned models, and streams that take up a new version between two micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.naive_bayes import Model
from ..storage import is_complete, numbered_folders
from .score import store_batches

_SCALARS = (
    "classes array<int>, bias array<double>, unit array<double>, value string, unseen_idf double, unit_length boolean"
)


@dataclass
class ModelStore:
    """Models under ``path``: for each version a table of weights, and a row with the rest.

    Versions are never changed. The row is written last, so a version that is seen is complete; one
    writer publishes at a time.
    """

    spark: SparkSession
    path: str

    def versions(self) -> list[int]:
        return numbered_folders(self.spark, f"{self.path}/scalars", "version")

    def latest(self) -> int:
        versions = self.versions()
        if not versions:
            raise ValueError(f"no model is published in {self.path}")
        return versions[-1]

    def publish(self, model: Model) -> int:
        """Store ``model`` as the next version and return its number."""
        version = max(self.versions(), default=0) + 1
        model.weights.write.mode("overwrite").parquet(f"{self.path}/weights/version={version}")
        row = (
            list(model.classes),
            [model.bias[c] for c in model.classes],
            [model.unit[c] for c in model.classes],
            model.value,
            model.unseen_idf,
            model.unit_length,
        )
        scalars = self.spark.createDataFrame([row], _SCALARS).coalesce(1)
        scalars.write.mode("overwrite").parquet(f"{self.path}/scalars/version={version}")
        return version

    def load(self, version: int) -> Model:
        row = self.spark.read.schema(_SCALARS).parquet(f"{self.path}/scalars/version={version}").first()
        weights = self.spark.read.parquet(f"{self.path}/weights/version={version}")
        return Model(
            tuple(row.classes),
            dict(zip(row.classes, row.bias, strict=True)),
            dict(zip(row.classes, row.unit, strict=True)),
            weights,
            {name: F.col(name) for name in weights.columns if name != "term"},
            value=row.value,
            unseen_idf=row.unseen_idf,
            unit_length=row.unit_length,
        )


def pinned_version(store: ModelStore, out_path: str, batch: int) -> int:
    """The version of a micro-batch: the latest when it is first tried, and that one whenever it is tried again."""
    pin = f"{out_path}/pins/batch={batch}"
    if is_complete(store.spark, pin):
        return store.spark.read.schema("version int").parquet(pin).first().version
    version = store.latest()
    store.spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").parquet(pin)
    return version


def score_versioned_stream(
    texts: DataFrame,
    store: ModelStore,
    score: Callable[[Model, DataFrame], DataFrame],
    out_path: str,
    checkpoint_path: str,
) -> StreamingQuery:
    """Score every micro-batch with the version that is the latest when it starts, named in ``model_version``.

    A version that is published while the stream runs is used from the next micro-batch on. The version of a batch is
    written down before it is scored, so a batch repeated after a failure gives the same rows, whatever was published
    meanwhile.
    """

    def versioned(batch: DataFrame, number: int) -> DataFrame:
        version = pinned_version(store, out_path, number)
        return score(store.load(version), batch).withColumn("model_version", F.lit(version))

    return store_batches(texts, versioned, f"{out_path}/scores", checkpoint_path)


def read_scores(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.option("basePath", f"{out_path}/scores").parquet(f"{out_path}/scores/batch=*")
