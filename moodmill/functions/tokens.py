"""Token cleaning as column expressions: text in, list of clean words out.

The per-token rules up to the number rule run as regular expressions over the
whole text, each behind a cheap test, and the text is split only once. A text
that holds no ``@`` never meets the mention pattern.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let, only_if
from .wordlists import PUNCTUATION, STOP_WORDS

SPACE = r" \t\n\x0B\f\r"
TOKEN_START = rf"(?<![^{SPACE}])"
RUN = r"(?s)(.)\1{2,}"

# Every character that Unicode gives a digit value: decimal digits, then the
# superscript, subscript, circled and other digits outside that category.
DIGIT = (
    r"[0-9\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
    r"\x{1369}-\x{1371}\x{19DA}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}]"
)


def tokenize(text: Column) -> Column:
    """Lower-case and split on every single white-space character."""
    return F.split(F.lower(text), f"[{SPACE}]")


def mark_mentions_and_links(text: Column) -> Column:
    """Replace a token holding ``@`` by AT_USER, else one holding a link by URL."""
    mentions = rf"{TOKEN_START}[^@{SPACE}]*+@[^{SPACE}]*"
    links = rf"{TOKEN_START}[^{SPACE}]*?(?:www\.|https?://)[^{SPACE}]*"
    text = only_if(
        text, lambda x: x.contains("@"), lambda x: F.regexp_replace(x, mentions, "AT_USER")
    )
    return only_if(
        text,
        lambda x: x.contains("www.") | x.contains("http://") | x.contains("https://"),
        lambda x: F.regexp_replace(x, links, "URL"),
    )


def _squeeze_token(token: Column) -> Column:
    # The leftmost run is cut to one character, and so is the same string elsewhere in
    # the token; a later run of the same letter can therefore end with two letters.
    def cut(word: Column, _: Column) -> Column:
        return let(
            F.regexp_extract(word, RUN, 0),
            lambda run: F.when(run == "", word).otherwise(F.replace(word, run, F.left(run, F.lit(1)))),
        )

    return F.aggregate(F.regexp_extract_all(token, F.lit(RUN), 0), token, cut)


def _same_letter_twice(text: Column) -> Column:
    """Whether two runs are of one letter; found in a single pass, however long the text is."""
    letters = F.regexp_extract_all(text, F.lit(RUN), F.lit(1))
    return let(letters, lambda x: F.size(x) > F.size(F.array_distinct(x)))


def squeeze_runs(text: Column) -> Column:
    """Cut a run of three or more equal characters to one, token by token."""
    plain = lambda x: F.regexp_replace(x, RUN, "$1")
    by_token = lambda x: F.array_join(
        F.transform(
            F.split(x, f"[{SPACE}]"),
            # Most tokens have no run and end at the first test.
            lambda w: F.when(~w.rlike(RUN), w).when(_same_letter_twice(w), _squeeze_token(w)).otherwise(plain(w)),
        ),
        " ",
    )
    return only_if(
        text,
        lambda x: x.rlike(RUN),
        lambda x: F.when(_same_letter_twice(x), by_token(x)).otherwise(plain(x)),
    )


def drop_number_led(text: Column) -> Column:
    """Empty every token whose first character is a digit."""
    # The wide digit class is tried only at the start of a token.
    number_led = rf"([{SPACE}]|^){DIGIT}[^{SPACE}]*"
    return only_if(
        text,
        lambda x: x.rlike(rf"(?:[{SPACE}]|^){DIGIT}"),
        lambda x: F.regexp_replace(x, number_led, "$1"),
    )


def remove_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(list(stop_words)))


def strip_punctuation(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.btrim(w, F.lit(PUNCTUATION)))


def drop_empty(tokens: Column) -> Column:
    return F.filter(tokens, lambda w: w != "")


def clean_tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The whole chain: placeholders, squeeze, numbers, stop words, punctuation, empties."""
    marked = drop_number_led(squeeze_runs(mark_mentions_and_links(F.lower(text))))
    words = F.split(marked, f"[{SPACE}]")
    return drop_empty(strip_punctuation(remove_stop_words(words, stop_words)))
