"""Training state that grows by deltas: new documents are counted, old ones are never read again.

The counts of a model (documents and term counts per class, the class sizes among them) are sums over
documents, so the counts of two sets of documents are the sums of theirs. A state is a folder with one table of
``count_by_class`` rows per added set; reading it sums them by term. What is derived from the sums at fitting
time (priors, IDF, likelihoods) needs no texts: raw counts, presence, and plain TF-IDF with its refitted IDF.
Unit-length TF-IDF is not such a sum, since a document's length changes with every IDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialise
from .naive_bayes import CLASSES, Counts, count_by_class, of_table

DELTA = "delta"


@dataclass
class TrainingState:
    """Counts in ``path``, a folder that every executor can reach."""

    spark: SparkSession
    path: str
    classes: Sequence[int] = CLASSES

    def add(self, name: str, entries: DataFrame, train: Column | None = None) -> None:
        """Count ``entries`` (``label, split, term, tf``) as the set ``name``.

        Adding a set again replaces it, so a repeated run does not count its documents twice. Sets must not
        share documents.
        """
        train = F.col("split") == "train" if train is None else train
        counted = count_by_class(entries, self.classes, train)
        counted.write.mode("overwrite").parquet(f"{self.path}/{DELTA}={name}")

    def table(self) -> DataFrame:
        """The sums over all sets: one shuffle of one narrow row per term and set."""
        deltas = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/{DELTA}=*").drop(DELTA)
        sums = [F.sum(c).alias(c) for c in deltas.columns if c != "term"]
        return deltas.groupBy("term").agg(*sums)

    def counts(self) -> Counts:
        return of_table(materialise(self.table(), "counts"), self.classes)

    def compacted(self, path: str, name: str = "compacted") -> TrainingState:
        """The same state with a single set in another folder; this one stays as it is."""
        self.table().write.parquet(f"{path}/{DELTA}={name}")
        return TrainingState(self.spark, path, self.classes)
