"""Fitted operators: held-out accuracy, textbook probabilities, odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodmill.llm import language_id, toxicity


def test_languages_held_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = language_id.identify(docs, language_id.fit(docs)).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    unseen = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.95 * len(unseen)


def test_languages_of_odd_rows(spark, odd, odd_rows, empty):
    model = language_id.fit(odd)
    got = language_id.identify(odd, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    by_key = {r.doc_id: r for r in got}
    assert by_key[1].lang_pred == by_key[2].lang_pred == by_key[3].lang_pred == "und"
    assert {r.lang_pred for r in got} <= {"en", "fr", "und"}
    assert by_key[None].held_out is False
    assert language_id.fit(empty) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def slow_chances(grams, size):
    """Interpolated Kneser-Ney by its definition: a function of (context, symbol)."""
    tables = {4: Counter(grams)}
    for n in (3, 2, 1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])

    def chance(gram):
        n = len(gram)
        if n == 0:
            return 1 / size
        often = tables[n]
        ones, twos = sum(v == 1 for v in often.values()), sum(v == 2 for v in often.values())
        discount = ones / (ones + 2 * twos) if ones else 0.5
        with_context = [v for g, v in often.items() if g[:-1] == gram[:-1]]
        total = sum(with_context)
        if not total:
            return chance(gram[1:])
        return max(often[gram] - discount, 0) / total + discount * len(with_context) / total * chance(gram[1:])

    return chance


def test_chances_equal_the_textbook():
    rng = random.Random(3)
    alphabet = {ord(c): language_id.FIRST_LETTER + i for i, c in enumerate("abcde")}
    table = language_id.symbol_table(alphabet)
    size = len(alphabet) + language_id.FIRST_LETTER
    counts, slow = [], []
    for mix in ("aaabbcd e", "edcba  bb"):
        texts = ["".join(rng.choice(mix) for _ in range(120)) for _ in range(3)]
        out, whose = language_id.symbols(texts, table)
        gram = language_id.grams(out, 4)[whose[3:] >= 0]
        counts.append(np.unique(gram, return_counts=True))
        plain = [tuple(int(x) for x in out[i - 3 : i + 1]) for i in range(3, len(out)) if whose[i] >= 0]
        slow.append(slow_chances(plain, size))
    orders, floor = language_id.fit_orders(counts, size)
    out, whose = language_id.symbols(["abcde eeaa zz dd", "q"], table)
    got = language_id.log_chances(out, orders, floor, 2)
    for i in np.flatnonzero(whose[3:] >= 0):
        gram = tuple(int(x) for x in out[i : i + 4])
        assert got[i].tolist() == pytest.approx([math.log(s(gram)) for s in slow], abs=1e-4)


def test_symbols_keep_texts_apart():
    table = language_id.symbol_table({ord("a"): 3, ord("b"): 4})
    out, whose = language_id.symbols(["a--b", "", "!!a", "B"], table)
    split = defaultdict(list)
    for s, w in zip(out.tolist(), whose.tolist(), strict=True):
        split[w].append(s)
    assert split[0] == [3, 1, 4] and split[2] == [3] and split[3] == [4] and split[-1] == [1] * 12


BAD = ["scorn", "vile", "rotten"]


def toxic_rows(n=400):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(3 + rng.randrange(6)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(60)]
        bad = i % 5 == 0
        for _ in range((1 + i // 5 % 10) if bad else 0):
            words[rng.randrange(60)] = rng.choice(BAD)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 2 == 0], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, known)).collect()}
    unseen = [(i, t) for i, t in labels if i % 2]
    assert sum(got[i].is_toxic == bool(t) for i, t in unseen) >= 0.97 * len(unseen)
    # Severity grows with the share of toxic words.
    weak = [got[i].severity for i, t in unseen if t and i // 5 % 10 < 3]
    strong = [got[i].severity for i, t in unseen if t and i // 5 % 10 > 6]
    assert np.mean(strong) > np.mean(weak) + 0.5
    assert all(0 <= r.severity <= 3 for r in got.values())


def test_ordinal_fit_orders_thresholds():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(600):
        present = [c for c in range(3) if rng.random() < 0.5]
        rows.append(present)
        grades.append(min(3, len(present) + int(rng.random() < 0.1)))
    weights, thresholds = toxicity.fit_ordinal(rows, np.array(grades), 3)
    assert (np.diff(thresholds) > 0).all() and (weights > 1).all()


def penalised(rows, grades, weights, thresholds):
    """The mean negative log-likelihood and the ridge, from the definition."""
    total = 0.0
    for row, grade in zip(rows, grades, strict=True):
        score = sum(weights[c] for c in row)
        below = [0.0, *(1 / (1 + math.exp(score - t)) for t in thresholds), 1.0]
        total -= math.log(below[grade + 1] - below[grade])
    return total / len(rows) + toxicity.RIDGE / 2 * sum(w * w for w in weights)


def test_ordinal_fit_is_at_the_least_loss():
    rng = random.Random(3)
    rows = [[c for c in range(5) if rng.random() < 0.4] for _ in range(300)]
    grades = np.array([min(3, max(0, round(sum(c < 3 for c in row) + rng.gauss(-0.5, 0.8)))) for row in rows])
    weights, thresholds = toxicity.fit_ordinal(rows, grades, 5)
    best = penalised(rows, grades, weights, thresholds)
    assert list(thresholds) == sorted(thresholds)
    for _ in range(60):
        moved = weights + np.array([rng.gauss(0, 0.1) for _ in weights])
        shifted = np.sort(thresholds + np.array([rng.gauss(0, 0.1) for _ in thresholds]))
        assert penalised(rows, grades, moved, shifted) >= best - 1e-6


def test_a_few_toxic_documents_carry_a_term_in_a_large_sample(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    rows = [(i, " ".join(word() for _ in range(20)) + ("" if i % 2 else " zzqx" if i < 72 else " vvqx")) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(4000)], "doc_id long, toxic int")
    # 36 of 2,000 toxic texts hold the one term, the others the other, none of the clean ones either.
    assert {"=zzqx", "=vvqx"} <= set(toxicity.fit(docs, labels).terms)
    noise = spark.createDataFrame([(i, rng.randrange(2)) for i in range(4000)], "doc_id long, toxic int")
    with pytest.warns(UserWarning, match="no term"):
        assert toxicity.fit(docs.select("doc_id", F.concat(F.lit("plain words "), "doc_id").alias("text")), noise) is None


def test_toxicity_of_odd_rows(spark, odd, odd_rows, empty):
    labels = spark.createDataFrame([(6, 0), (9, 1), (9, None), (10, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    assert all(r.severity == 0 and not r.is_toxic for r in got if r.doc_id in (1, 2, 3))
    assert toxicity.fit(odd, labels.filter("toxic = 0")) is None
    assert toxicity.score(odd, None).agg(F.max("severity")).first()[0] == 0
    assert toxicity.score(empty, model).count() == 0 and toxicity.fit(empty, labels) is None
