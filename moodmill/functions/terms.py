"""Terms of a text and their counts, computed inside the row without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

# The entry that every document carries once besides its terms. Its counts are the
# sizes of the classes, and a document without any term still has a row.
NO_TERM = ""
NO_BUCKET = -1


def word_terms(text: Column) -> Column:
    """Lower-cased words of two or more word characters."""
    # The ASCII ranges are part of the Unicode classes and are tried first.
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9_\p{L}\p{N}]{2,}"), 0)


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of ``low`` to ``high`` neighbouring tokens, joined by a space."""

    def of_size(t: Column, n: int) -> Column:
        if n == 1:
            return t
        starts = F.slice(t, F.lit(1), F.greatest(F.size(t) - (n - 1), F.lit(0)))

        def join(word: Column, i: Column) -> Column:
            rest = [part for k in range(1, n) for part in (F.lit(" "), F.get(t, i + k))]
            return F.concat(word, *rest)

        return F.transform(starts, join)

    return let(tokens, lambda t: F.concat(*[of_size(t, n) for n in range(low, high + 1)]))


def count_entries(terms: Column, extra: str | int) -> Column:
    """``array<struct<term, tf>>`` of one document, with one ``extra`` entry.

    Sorting the terms puts equal ones side by side; the count of a term is the
    distance from its first position to that of the next term.
    """

    def measure(s: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)),
        )
        return let(
            first,
            lambda starts: F.transform(
                starts,
                lambda at, j: F.struct(
                    F.get(s, at).alias("term"),
                    (F.coalesce(F.get(starts, j + 1), F.size(s)) - at).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(F.concat(terms, F.array(F.lit(extra)))), measure)
