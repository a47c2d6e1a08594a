"""String cleaning as column expressions: text in, normalised text out.

Character classes are spelled out so that white space, digits and word
characters mean the Unicode classes, whatever the regex engine's default is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let, only_if
from .wordlists import COMMON_CONTRACTIONS

SPACE = r"\t-\r\x{1C}- \x{85}\p{Z}"
# The ASCII ranges are part of the Unicode classes; a class is tried from left to right.
WORD = r"a-z0-9A-Z_\p{L}\p{N}"

POSITIVE = " positiveemoji "
NEGATIVE = " negetiveemoji "

# The emoticon groups in the order in which they are replaced. The
# spelling of the negative marker is part of the result. Each pattern begins with the
# class of its first characters, so that other characters cost a single test.
EMOTICONS = (
    (rf"[:(](?:(?<=:)(?:[{SPACE}]?\)|-\)|'\)|O)|(?<=\()[-{SPACE}]?:)", POSITIVE),
    (rf"[:xX](?:(?<=:)[-{SPACE}]?|(?<=[xX])-?)D", POSITIVE),
    (r"[<:](?:(?<=<)3|(?<=:)\*)", POSITIVE),
    (r"[;(@](?:(?<=;)-?[)D]|(?<=\()-?;|(?<=@)-\))", POSITIVE),
    (rf"[:)](?:(?<=:)(?:[{SPACE}]?\(|-[(/|])|(?<=\))[-{SPACE}]?:)", NEGATIVE),
    (r""":[,'"]\(""", NEGATIVE),
)


# What counts as a mention and as a link.
MENTION = f"@[^{SPACE}]+"
LINK = rf"(www\.[^{SPACE}]+)|(https?://[^{SPACE}]+)"


def normalize_basic(text: Column) -> Column:
    """Lower-case; remove mentions; blank out links, digits and quote entities."""
    text = only_if(
        F.lower(text),
        lambda x: x.contains("@"),
        lambda x: F.regexp_replace(x, MENTION, ""),
    )
    text = only_if(
        text,
        lambda x: x.contains("www.") | x.contains("http"),
        lambda x: F.regexp_replace(x, LINK, " "),
    )
    text = F.regexp_replace(text, r"\p{Nd}+", " ")
    return F.replace(text, F.lit("&quot;"), F.lit(" "))


def replace_emoticons(text: Column) -> Column:
    def chain(x: Column) -> Column:
        for pattern, marker in EMOTICONS:
            x = F.regexp_replace(x, pattern, marker)
        return x

    return only_if(text, lambda x: x.rlike(r"[:;]|<3|[xX]-?D|@-\)"), chain)


def drop_single_letters(text: Column) -> Column:
    # Letters inside a word end at a test of one ASCII range; the wide classes are tried last.
    return F.regexp_replace(text, f"(?<![a-z])[a-zA-Z](?![a-z])(?![{WORD}])(?<![{WORD}][a-zA-Z])", "")


def _expanded(text: Column, longs: Column, known: Callable[[Column], Column]) -> Column:
    """Replace the known words of ``text`` one after the other, in the order of the text.

    Every replacement reads the whole text, so a word is replaced where it first occurs and its repetitions are left
    out: they change nothing unless a later replacement has formed the word anew. This is tested, and where it is so,
    or a test costs more than it saves, every occurrence has its turn.
    """

    def replaced(acc: Column, w: Column) -> Column:
        return F.replace(acc, w, longs[F.lower(w)])

    def state(changed: Column, settled: Column, done: Column) -> Column:
        return F.struct(changed.alias("text"), settled.alias("settled"), done.alias("done"))

    def once_each(own: Column) -> Column:
        def step(acc: Column, w: Column) -> Column:
            def check(x: Column) -> Column:
                back = F.exists(F.slice(own, F.lit(1), acc["done"]), lambda u: x.contains(u))
                return state(x, acc["settled"] & ((x == acc["text"]) | ~back), acc["done"] + 1)

            return let(replaced(acc["text"], w), check)

        return F.aggregate(own, state(text, F.lit(True), F.lit(1)), step)

    def expand(words: Column, own: Column) -> Column:
        in_turn = F.aggregate(words, text, replaced)
        checks = F.size(own) * (F.size(own) + 1) / 2
        short = let(once_each(own), lambda r: F.when(r["settled"], r["text"]).otherwise(in_turn))
        return F.when(checks < F.size(words), short).otherwise(in_turn)

    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: known(F.lower(w)))
    return let(words, lambda x: let(F.array_distinct(x), lambda own: expand(x, own)))


def expand_contractions(
    text: Column, contractions: Mapping[str, str] | Column = COMMON_CONTRACTIONS
) -> Column:
    """Expand each white-space word found in the dictionary, wherever it occurs in the text.

    The dictionary is a short mapping, or a map column with at least the words of its row; ``operators.lookup`` makes
    that column from a dictionary table of any size.
    """
    if isinstance(contractions, Column):
        return let(text, lambda x: _expanded(x, contractions, lambda w: F.map_contains_key(contractions, w)))
    if not contractions:
        return text
    shorts = list(contractions)
    longs = F.create_map(*[F.lit(x) for pair in contractions.items() for x in pair])

    def expand(x: Column) -> Column:
        return _expanded(x, longs, lambda w: w.isin(shorts))

    if all("'" in short for short in shorts):
        return only_if(text, lambda x: x.contains("'"), expand)
    return let(text, expand)


def blank_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, f"[^{WORD}{SPACE}]", " ")


def squeeze_to_two(text: Column) -> Column:
    """Cut a run of equal characters to two; line breaks stay as they are."""
    return F.regexp_replace(text, r"(?d)(.)\1{2,}", "$1$1")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+", " ")


def blank_and_collapse(text: Column) -> Column:
    """``collapse_spaces(blank_punctuation(text))`` in one pass: whatever is no word character ends up as one space."""
    return F.regexp_replace(text, f"[^{WORD}]+", " ")


def normalize_text(
    text: Column, contractions: Mapping[str, str] | Column = COMMON_CONTRACTIONS
) -> Column:
    """The whole chain, in its fixed order.

    Runs of spaces may be collapsed before other runs are squeezed: a run of one character is either of spaces, and
    ends as one space, or holds none.
    """
    text = drop_single_letters(replace_emoticons(normalize_basic(text)))
    return squeeze_to_two(blank_and_collapse(expand_contractions(text, contractions)))
