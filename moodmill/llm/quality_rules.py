"""Quality rules: a table of thresholds compiled into a projection of built-in functions.

Every row of ``RULES`` is a measure with the smallest and the largest value that passes; the
verdict is the conjunction of all rows, built by ``verdict`` at plan time. No user function runs.

Defined results: a null text counts as an empty one (no words, so it fails); an empty table
gives an empty table; repeated rows are judged one by one and alike; extra input columns are
ignored by ``measure`` and returned untouched by ``keep``; a very long text is measured whole; ties do not arise.

The stop-word rule knows English, French, German and Spanish words. A longer text in any other language fails it;
``rules`` without that line judge such corpora.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmill.llm.text import BREAKS, filter_computed, word_array

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for on with as by at from or are was be this "
    "de la le les et des en un une du est que pour dans sur au pas qui par "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als "
    "el los las y del se por con una su para es al lo como más"
).split()

#: Words of a window whose repetition inside a text counts.
WINDOW = 5


class Rule(NamedTuple):
    measure: str
    least: float | None
    most: float | None


#: The threshold table. Ratios are per word, but for line measures, which are per line with a word.
RULES = (
    Rule("n_words", 10, None),
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.3),
    Rule("words_per_stop_word", None, 60),
    Rule("dup_line_ratio", None, 0.5),
)


def _repeated_starts(entries: Column) -> Column:
    """Sorted places ``i`` of the entries whose hash occurs twice or more in the sorted array."""

    def is_repeated(entry: Column, at: Column) -> Column:
        before = F.get(entries, at - 1)["h"] == entry["h"]
        after = F.get(entries, at + 1)["h"] == entry["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.sort_array(F.transform(F.filter(entries, is_repeated), lambda e: e["i"]))


def _covered(starts: Column) -> Column:
    """How many words the windows that start at these sorted places cover together."""
    steps = F.zip_with(
        F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
        F.slice(starts, 1, F.greatest(F.size(starts) - 1, F.lit(0))),
        lambda later, earlier: F.least(later - earlier, F.lit(WINDOW)),
    )
    total = F.aggregate(steps, F.lit(WINDOW), lambda acc, step: acc + step)
    return F.when(F.size(starts) == 0, F.lit(0)).otherwise(total)


def measure(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` columns, the base measures, the ratios and ``kept`` for every row of ``docs``."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        *(F.col(c) for c in keep),
        word_array(F.col(text)).alias("_words"),
        F.length(F.translate(body, BREAKS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BREAKS)) != "").alias("_lines"),
    )
    spelt = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    counted = base.select(
        *(F.col(c) for c in keep),
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: w.isin(spelt))).cast("long").alias("n_stop_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_ids"),
    )
    last = F.col("n_words").cast("int") - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*(F.get(F.col("_ids"), i + k) for k in range(WINDOW))),
    )
    hashed = counted.withColumn(
        "_hashes", F.when(last < 1, F.array().cast("array<bigint>")).otherwise(hashes)
    ).drop("_ids")
    # Only a text with an equal pair is sorted.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    entries = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    sorted_ = hashed.withColumn("_sorted", F.when(repeats, F.sort_array(entries)).otherwise(none))
    starts = sorted_.drop("_hashes").withColumn("_starts", _repeated_starts(F.col("_sorted"))).drop("_sorted")
    words = F.greatest(F.col("n_words"), F.lit(1))
    full = starts.withColumn("n_repeat_words", _covered(F.col("_starts")).cast("long")).drop("_starts")
    rated = full.withColumns(
        {
            "mean_word_chars": F.col("word_chars") / words,
            "symbol_ratio": F.col("n_symbols") / words,
            "words_per_stop_word": F.col("n_words") / (F.col("n_stop_words") + 1),
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "base_failed": (F.col("n_words") < 10)
            | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        }
    )
    return rated.withColumn("kept", ~F.col("base_failed") & verdict(RULES))


def verdict(rules: tuple[Rule, ...]) -> Column:
    """One boolean expression for a threshold table."""
    passed = F.lit(True)
    for rule in rules:
        if rule.least is not None:
            passed = passed & (F.col(rule.measure) >= rule.least)
        if rule.most is not None:
            passed = passed & (F.col(rule.measure) <= rule.most)
    return passed


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns and no others."""
    whole = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    return filter_computed(measure(whole, "_row", text="_text"), F.col("kept")).select("_row.*")
