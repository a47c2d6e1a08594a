"""Cleaning rules on literal rows and against plain Python on generated texts."""

import random
import re
import sys
import time
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodmill.functions import normalize as norm
from moodmill.functions import tokens as tok
from moodmill.functions.wordlists import PUNCTUATION, STOP_WORDS

FEW_STOPS = ["the", "and", "you", "i"]


def test_word_list_sizes():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 127
    assert len(PUNCTUATION) == 32


def test_clean_tokens_on_literal_rows(column):
    cases = {
        "@Air thanks http://t.co/x www.a.com me@b.org": ["AT_USER", "thanks", "URL", "URL", "AT_USER"],
        "Soooo goooood!!! the, the": ["so", "god", "the"],
        "#1 2nd b4 10am": ["1", "b4"],
        "ok :) bad :-( cry :'( kiss :* wink ;-)": ["ok", "bad", "cry", "kiss", "wink"],
        ":D xD <3 @-)": ["d", "xd", "3", "AT_USER"],
        "don't you're they'll we've i'll": ["don't", "you're", "they'll", "we've", "i'll"],
        "say &quot;hi&quot; &amp; go": ["say", "quot;hi&quot", "amp", "go"],
        "naïve café über_x ½": ["naïve", "café", "über_x", "½"],
        "² ①b x²": ["x²"],
        "a@b http://x@y www.x": ["AT_USER", "AT_USER", "URL"],
        "": [],
        "   ": [],
    }
    got = column(lambda t: tok.clean_tokens(t, FEW_STOPS), list(cases))
    assert got == list(cases.values())
    assert column(tok.clean_tokens, [None]) == [None]


def test_squeeze_cuts_the_same_string_everywhere_in_a_token(column):
    texts = ["aaabaaaa", "aaaabaaaaaabaaa", "aaab aaaa", "---x----y", "aabb", "aaabbbaaa", "ｅ̈eee"]
    want = ["abaa", "abaaaba", "ab a", "-x--y", "aabb", "aba", "ｅ̈e"]
    # second: 4 a's -> a, then 6 a's hold one run of 4 (aaaaaa -> aaa), which is cut in turn
    want[1] = squeeze_by_hand(texts[1])
    assert column(tok.squeeze_runs, texts) == want


def squeeze_by_hand(text):
    """Leftmost run of three or more to one letter, the same string everywhere, until none is left."""
    words = []
    for word in re.split(r"[ \t\n\x0b\f\r]", text):
        while run := re.search(r"(.)\1{2,}", word, re.S):
            word = word.replace(run.group(), run.group()[0])
        words.append(word)
    return " ".join(words)


def test_squeeze_matches_plain_python_on_random_words(column):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aab-é ") * rng.choice([1, 1, 2, 3, 4, 5]) for _ in range(12)) for _ in range(400)]
    got = column(lambda t: F.array_join(tok.drop_empty(F.split(tok.squeeze_runs(t), " ")), " "), texts)
    want = [" ".join(w for w in squeeze_by_hand(t).split(" ") if w) for t in texts]
    assert got == want


def test_digit_class_is_the_set_of_digit_characters(column):
    everything = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    digits = {c for c in everything if c.isdigit()}
    extra = {"\U0001FBF0"}  # a digit character in each engine's tables, whatever their version
    assert extra <= digits or unicodedata.unidata_version < "13"
    matched = column(lambda t: t.rlike(f"^{tok.DIGIT}"), everything)
    found = {c for c, hit in zip(everything, matched, strict=True) if hit}
    assert not {c for c in found ^ digits if unicodedata.category(c) != "Nd"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB1@#.:/w '\n\té²", max_size=30), min_size=20, max_size=20))
def test_clean_tokens_has_clean_words(column, texts):
    for words in column(tok.clean_tokens, texts):
        for w in words:
            assert w and not re.search(r"[ \t\n]", w)
            assert w == w.strip(PUNCTUATION)


def test_normalize_up_to_single_letters(column):
    cases = {
        "@Air thanks http://t.co/x www.a.com me@b.org": "thanks me",
        "Soooo goooood!!! the, the": "soooo goooood!!! the, the",
        "#1 2nd b4 10am": "# nd am",
        ":D xD <3 @-)": ": xd <",
        "don't you're they'll we've i'll": "don' you're they'll we've 'll",
        "say &quot;hi&quot; &amp; go": "say hi &amp; go",
        "naïve café über_x ½": "naïve café über_x ½",
    }
    chain = lambda t: norm.drop_single_letters(norm.replace_emoticons(norm.normalize_basic(t)))
    got = [" ".join(x.split()) for x in column(chain, list(cases))]
    assert got == list(cases.values())


def test_emoticons(column):
    plus, minus = "positiveemoji", "negetiveemoji"
    cases = {
        "ok :) : ) :-) (: ( : (-: :')": f"ok {' '.join([plus] * 7)}",
        "kiss :* wink ;-) ;) (; (-;": f"kiss {plus} wink {' '.join([plus] * 4)}",
        "a :-( b :( c : ( d ): e ) : f )-: g :-/ h :-|": " ".join(f"{x} {minus}" for x in "abcdefgh"),
        "cry :,( or :'( or :\"(": f"cry {minus} or {minus} or {minus}",
        # a smile is found before the sad marks that share its characters
        ":( :(": f": {plus} (",
        "plain: text; here": "plain: text; here",
    }
    got = [" ".join(x.split()) for x in column(norm.replace_emoticons, list(cases))]
    assert got == list(cases.values())


def test_contractions_replace_every_occurrence(column):
    texts = ["you're you're, (You're", "we've, we've", "they'll-they'll", "no marks"]
    want = ["you are you are, (You're", "we have, we have", "they'll-they'll", "no marks"]
    assert column(norm.expand_contractions, texts) == want
    # a word of the text is replaced inside other words too
    swapped = column(lambda t: norm.expand_contractions(t, {"ab": "x"}), ["ab abc", "abc", "AB ab"])
    assert swapped == ["x xc", "abc", "x x"]


def _expanded_in_turn(text, dictionary):
    for word in text.split():
        if word.lower() in dictionary:
            text = text.replace(word, dictionary[word.lower()])
    return text


def test_contractions_are_linear_in_the_text(column):
    # Searched once per occurrence, this text takes 200 thousand passes over 2 MB, which is minutes.
    text = "We're sure they'll go, " * 100_000
    want = text.replace("We're", "we are").replace("they'll", "they will")
    began = time.monotonic()
    assert column(norm.expand_contractions, [text]) == [want]
    assert time.monotonic() - began < 40


def test_contractions_formed_anew_are_replaced_again(column):
    dictionary = {"ab": "b", "b": "ab", "aa": "", "ba": "a", "c": "ba"}
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcA", k=rng.randrange(1, 4))) for _ in range(12)) for _ in range(200)]
    got = column(lambda t: norm.expand_contractions(t, dictionary), texts)
    assert got == [_expanded_in_turn(t, dictionary) for t in texts]


def test_emoticons_group_by_group(column):
    space = "[\t-\r\x1c- \x85\xa0\u2003]"
    groups = [
        (rf"(:{space}?\)|:-\)|\({space}?:|\(-:|:'\)|:O)", norm.POSITIVE),
        (rf"(:{space}?D|:-D|x-?D|X-?D)", norm.POSITIVE),
        (r"(<3|:\*)", norm.POSITIVE),
        (r"(;-?\)|;-?D|\(-?;|@-\))", norm.POSITIVE),
        (rf"(:{space}?\(|:-\(|\){space}?:|\)-:|:-/|:-\|)", norm.NEGATIVE),
        (r"""(:,\(|:'\(|:"\()""", norm.NEGATIVE),
    ]
    rng = random.Random(5)
    texts = ["".join(rng.choices("::;()()<3xXDO'\"--*@,/| a\xa0\u2003é😀", k=40)) for _ in range(400)]

    def in_turn(text):
        for pattern, marker in groups:
            text = re.sub(pattern, marker, text)
        return text

    assert column(norm.replace_emoticons, texts) == [in_turn(t) for t in texts]


def test_single_letters_beside_other_letters(column):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abZ é_1½-', \u0301", k=30)) for _ in range(300)]
    want = [re.sub(r"(?<![\w½])[a-zA-Z](?![\w½])", "", t) for t in texts]
    assert column(norm.drop_single_letters, texts) == want


def test_normalize_tail(column):
    assert column(norm.squeeze_to_two, ["aaab  \n\n\n!!!", "aa"]) == ["aab  \n\n\n!!", "aa"]
    assert column(norm.blank_punctuation, ["a-b_c é½!"]) == ["a b_c é½ "]
    assert column(norm.collapse_spaces, [" a   b\n\n"]) == [" a b "]
    got = column(norm.normalize_text, ["You're SOOOO good!!! :) x &amp; 12th", None])
    assert got == [" you are soo good positiveemoji amp th".lstrip(), None]


def test_unicode_spaces_end_a_mention(column):
    assert column(norm.normalize_basic, ["@me x @you y"]) == [" x  y"]


def test_blanks_are_one_pass_and_the_chain_is_its_steps(spark, column):
    rng = random.Random(11)
    # Marks and white space of several planes, a letter that lower-cases to two, line ends, runs of everything.
    marks = ["a", "b", "İ", "é", "ß", "_", "7", "Ⅷ", " ", "  ", "\n", "\r\n", "\t", "\x1c", "\x85", " ", " ", ".", "!!!", "'", "-", ":", ")", "(", "D", "x", "é", "😀", "😀", "𝒜", "i'm", "don't"]
    texts = ["".join(rng.choice(marks) * rng.choice((1, 1, 2, 4)) for _ in range(rng.randint(0, 60))) for _ in range(300)]

    def stepwise(t):
        t = F.regexp_replace(
            norm.replace_emoticons(norm.normalize_basic(t)), f"[a-zA-Z](?![{norm.WORD}])(?<![{norm.WORD}][a-zA-Z])", ""
        )
        return norm.collapse_spaces(norm.squeeze_to_two(norm.blank_punctuation(norm.expand_contractions(t))))

    assert column(norm.normalize_text, texts) == column(stepwise, texts)
    rows = spark.createDataFrame([("a",)], "text string")
    plan = lambda c: rows.select(c)._jdf.queryExecution().analyzed().toString().lower()
    passes = [plan(f(F.col("text"))).count("regexp_replace(") for f in (stepwise, norm.normalize_text)]
    assert passes[1] < passes[0]
