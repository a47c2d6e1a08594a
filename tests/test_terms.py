import random
from collections import Counter

from moodmill.functions import terms
from moodmill.functions.hashing import hash32, hash_bucket
from pyspark.sql import functions as F


def test_count_entries_equals_a_counter(column):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdé") for _ in range(n)) for n in (1, 2, 5, 50, 400)]
    got = column(lambda t: terms.count_entries(F.split(t, " "), terms.NO_TERM), texts)
    for text, entries in zip(texts, got, strict=True):
        counted = {e.term: e.tf for e in entries}
        assert counted.pop("") == 1
        assert counted == Counter(text.split(" "))


def test_no_words_leave_the_extra_entry(column):
    got = column(lambda t: terms.count_entries(terms.word_terms(t), terms.NO_TERM), ["", "a ! 1"])
    assert [[tuple(e) for e in entries] for entries in got] == [[("", 1)], [("", 1)]]


def test_ngrams(column):
    words = lambda t: F.split(t, " ")
    assert column(lambda t: terms.ngrams(words(t), 1, 2), ["a b c", "a"]) == [
        ["a", "b", "c", "a b", "b c"],
        ["a"],
    ]
    assert column(lambda t: terms.ngrams(words(t), 2, 3), ["a b c d", "a b"]) == [
        ["a b", "b c", "c d", "a b c", "b c d"],
        ["a b"],
    ]
    assert column(lambda t: terms.ngrams(terms.word_terms(t)), [""]) == [[]]


def test_word_terms(column):
    assert column(terms.word_terms, ["Ab c _x é1! don't"]) == [["ab", "_x", "é1", "don"]]


def test_hash_is_the_head_of_md5(column):
    import hashlib

    want = int(hashlib.md5("wörd".encode()).hexdigest()[:8], 16)
    assert column(hash32, ["wörd"]) == [want]
    assert column(lambda t: hash_bucket(t, 1500), ["wörd"]) == [want % 1500]
