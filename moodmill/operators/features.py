"""Long feature tables: one row per document and term."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket
from ..functions.terms import NO_BUCKET, NO_TERM, count_entries
from .skew import join_per_term

NUM_FEATURES = 25_000


def term_vector(terms: Column) -> Column:
    """Counted terms of a document, with one ``NO_TERM`` entry."""
    return count_entries(terms, NO_TERM)


def bucket_vector(tokens: Column, num_features: int = NUM_FEATURES) -> Column:
    """The same with ``term`` a bucket number below ``num_features``, or ``NO_BUCKET``."""
    buckets = F.transform(tokens, lambda t: hash_bucket(t, num_features))
    return count_entries(buckets, NO_BUCKET)


def unfold(df: DataFrame, vector: Column, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, ``term`` and ``tf``: one row per entry of ``vector``."""
    # inline_outer: plain inline would evaluate the array again to filter out empty ones.
    return df.select(*keep, F.inline_outer(vector))


def real_terms(entries: DataFrame) -> DataFrame:
    """Entries without the extra one that every document carries."""
    is_bucket = dict(entries.dtypes)["term"] == "int"
    return entries.filter(F.col("term") != (NO_BUCKET if is_bucket else NO_TERM))


def ml_hashing_tf(df: DataFrame, tokens: str, num_features: int = NUM_FEATURES) -> DataFrame:
    """``pyspark.ml`` term hashing, unpacked to ``doc_id, bucket, tf`` rows."""
    hashed = HashingTF(inputCol=tokens, outputCol="features", numFeatures=num_features).transform(df)
    vector = F.unwrap_udt(F.col("features"))
    pairs = F.arrays_zip(vector["indices"].alias("bucket"), vector["values"].alias("tf"))
    return hashed.select("doc_id", F.inline_outer(pairs)).dropna("any")


def vocabulary(entries: DataFrame) -> DataFrame:
    """Every term with its document frequency and total count."""
    return entries.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


def idf_plain(df_column: Column, n_docs: Column | int) -> Column:
    """``ln((m + 1) / (df + 1))``, the form of Spark's own IDF."""
    return F.log((F.lit(n_docs) + 1.0) / (df_column + 1.0))


def idf_smooth(df_column: Column, n_docs: Column | int) -> Column:
    """``ln((1 + n) / (1 + df)) + 1``."""
    return F.log((F.lit(n_docs) + 1.0) / (df_column + 1.0)) + 1.0


def tfidf(
    entries: DataFrame,
    idf: DataFrame,
    hot: DataFrame,
) -> DataFrame:
    """``tf * idf`` of the entries whose term is in ``idf(term, idf)``."""
    joined = join_per_term(entries, idf, hot, how="inner")
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf"))


def unit_length(weighted: DataFrame, column: str = "tfidf", key: str = "doc_id") -> DataFrame:
    """Divide each weight by the Euclidean length of its document's weights."""
    squares = F.sum(F.col(column) * F.col(column)).over(Window.partitionBy(key))
    return weighted.withColumn(column, F.col(column) / F.sqrt(squares))
