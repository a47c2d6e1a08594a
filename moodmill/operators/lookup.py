"""Replacement by a dictionary that is a table, however large it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import SPACE, expand_contractions
from ..storage import materialise
from .skew import count_hot_keys, join_per_term


def found_entries(docs: DataFrame, dictionary: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``found``, a map of the document's own words that the ``short, long`` dictionary holds.

    The distinct words of each document are joined with the dictionary by word. A word that most documents share is
    dealt over salts, its dictionary row repeated that often. Only found words go back to their document, so a
    map is bounded by the words of its text; no task holds the dictionary.
    """
    # A document's word in any case is looked up in lower case.
    own = F.array_distinct(F.transform(F.split(text, f"[{SPACE}]+"), F.lower))
    words = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.explode(own).alias("term"))
    stored = materialise(words.filter("term <> ''"), "words")
    table = dictionary.select(F.col("short").alias("term"), "long")
    met = join_per_term(stored, table, count_hot_keys(stored), how="inner")
    listed = met.groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("term", "long"))).alias("found"))
    return listed.withColumnRenamed("doc_id", key)


def expand_from_table(docs: DataFrame, dictionary: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every white-space word of ``text`` that is in the dictionary replaced, wherever it occurs in the text.

    The same result as ``expand_contractions`` with the dictionary as a map: words are replaced in the order of the
    text. ``dictionary`` has one row per ``short``. A null text stays null; a row without a key is looked up as
    the others are.
    """
    found = materialise(found_entries(docs, dictionary, key, text), "found-words").withColumnRenamed(key, "_key")
    met = docs.join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
    changed = F.when(F.col("found").isNull(), F.col(text)).otherwise(expand_contractions(F.col(text), F.col("found")))
    return met.select(*[changed.alias(c) if c == text else F.col(c) for c in docs.columns])
