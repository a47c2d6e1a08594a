"""Toxicity: severity grades by cumulative-link ordinal regression over sparse text features.

*Grades.* Labels say toxic or not. A document that is not toxic has grade 0. Toxic ones get grade 1, 2
or 3 by the share of their words that carry a toxic term, cut at the terciles of the sample.

*Features.* Words and word beginnings of 4, 5 and 6 letters (compounds keep their stem). Of these, the
model keeps the terms most over-represented in toxic documents, counted over the whole sample. A term has to
stand out against chance: the evidence, n times the divergence of its share of toxic documents from that of the
sample, must exceed the log of the number of terms by ``MARGIN``, and ``MOST_DOCS`` toxic documents are enough, however
large the sample. The model adds one feature for the share of words that carry such a term, in powers of two.

*Model.* P(grade <= k) = logistic(theta_k - w.x) with one weight vector for all thresholds and
theta_1 < theta_2 < theta_3. Severity is the expected grade, from 0 to 3; a document is called toxic if
P(grade >= 1) is above the cut that makes the fewest errors in the sample.

The sample is bounded by ``SAMPLE`` labelled rows, taken by a hash of the key, and the model by
``TERMS`` terms; every document is scored, as a whole.

Defined results: a null text or one without letters has no features and is not toxic (severity 0); a
label that is null is no label, and a key labelled twice takes the larger; without labels of both
kinds, or if no term stands out (with a warning), every severity is 0; a very long text is scored whole; repeated
rows are scored alike, equal chances are ties on one side of the cut; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodmill.storage import materialise

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
#: Terms of the model, at most.
TERMS = 4096
#: Toxic documents that a term needs: a share of those in the sample, but no fewer and no more than these numbers (near
#: copies share their rare words, so a handful proves little). How much more often than others they must have it,
#: and by how much its evidence must exceed the log of the number of terms (natural logs).
LEAST_DOCS, MOST_DOCS = 4, 32
LEAST_SHARE = 0.02
LEAST_LIFT = 8.0
MARGIN = 3.0
PREFIXES = (4, 5, 6)
GRADES = 4
#: Features for the share of words with a term: log2 of the share, from 2**-12 up.
SHARE_BINS = 13
RIDGE = 1e-4
STEPS = 400

_WORD = re.compile(r"[^\W\d_]+")
#: Words that a task remembers the terms of.
CACHE_WORDS = 200_000


class Model(NamedTuple):
    terms: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float


def terms_of(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in PREFIXES if len(word) > n)]


def _term_columns(text: Column) -> Column:
    """The distinct terms of a text, as ``terms_of`` gives them."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))
    parts = F.transform(
        words,
        lambda w: F.array_append(
            F.filter(
                F.array(*(F.when(F.length(w) > n, F.substring(w, 1, n)) for n in PREFIXES)),
                lambda p: p.isNotNull(),
            ),
            F.concat(F.lit("="), w),
        ),
    )
    return F.array_distinct(F.flatten(parts))


class Reader:
    """Turns texts into term numbers and the share of words that carry one."""

    def __init__(self, terms: dict[str, int]) -> None:
        self.terms = terms
        self.known: dict[str, tuple[int, ...]] = {}

    def numbers(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = tuple(self.terms[t] for t in terms_of(word) if t in self.terms)
            if len(self.known) < CACHE_WORDS and len(word) <= 64:
                self.known[word] = found
        return found

    def read(self, text: str | None) -> tuple[list[int], float]:
        words = _WORD.findall((text or "").lower())
        present: set[int] = set()
        hits = 0
        get = self.known.get
        for word in words:
            found = get(word)
            if found is None:
                found = self.numbers(word)
            if found:
                hits += 1
                present.update(found)
        return sorted(present), hits / len(words) if words else 0.0


def features(numbers: list[int], share: float, n_terms: int) -> list[int]:
    if not numbers:
        return []
    level = int(np.clip(np.floor(np.log2(max(share, 1e-9))) + SHARE_BINS - 1, 0, SHARE_BINS - 1))
    return [*numbers, n_terms + level]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by full-batch Adam on the cumulative-link likelihood."""
    lengths = np.array([len(r) for r in rows])
    column = np.array([c for r in rows for c in r], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    n, cuts = len(rows), GRADES - 1
    # theta_1 and the logs of the steps to the next ones, so that the order always holds.
    free = np.concatenate([np.zeros(size), [1.0], np.zeros(cuts - 1)])
    first, second = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, STEPS + 1):
        weights, bounds = free[:size], free[size:]
        theta = np.cumsum(np.r_[bounds[0], np.exp(bounds[1:])])
        score = np.bincount(row, weights=weights[column], minlength=n)
        below = np.c_[np.zeros(n), _sigmoid(theta[None, :] - score[:, None]), np.ones(n)]
        at = np.arange(n)
        high, low = below[at, grades + 1], below[at, grades]
        chance = np.maximum(high - low, 1e-12)
        slope = below * (1 - below)
        d_score = (slope[at, grades + 1] - slope[at, grades]) / chance / n
        d_theta = np.zeros(cuts)
        for k in range(cuts):
            up = (grades == k) * slope[:, k + 1] / chance
            down = (grades == k + 1) * slope[:, k + 1] / chance
            d_theta[k] = -(up - down).sum() / n
        d_bounds = np.r_[d_theta.sum(), [np.exp(b) * d_theta[k + 1 :].sum() for k, b in enumerate(bounds[1:])]]
        gradient = np.concatenate([np.bincount(column, weights=d_score[row], minlength=size) + RIDGE * weights, d_bounds])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        free = free - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return free[:size], np.cumsum(np.r_[free[size], np.exp(free[size + 1 :])])


def sample_of(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, bound: int) -> DataFrame:
    """``text, toxic`` of at most ``bound`` labelled documents, a row per text, stored."""
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("k"))
        .agg(F.max(label).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("k"), "k")
        .limit(bound)
    )
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null")
    # At most ``bound`` keys.
    labelled = narrow.join(F.broadcast(chosen), "k").select("toxic", "text")
    # Copies would make their rarest words look typical.
    return materialise(labelled.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample")


def _times_log(count: str, expected: float) -> Column:
    """``count`` times the log of its share of ``bad + good`` over the expected one."""
    share = F.col(count) / (F.col("bad") + F.col("good"))
    return F.when(F.col(count) > 0, F.col(count) * F.log(share / expected)).otherwise(0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    bound: int = SAMPLE,
) -> Model | None:
    """The model, or None where the labels do not hold both kinds or no term stands out."""
    sample = sample_of(docs, labels, key, text, label, bound)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    counted = (
        sample.select("toxic", F.explode(_term_columns(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    counted = materialise(counted, "toxic-terms")
    lift = ((F.col("bad") + 0.1) / sizes[1]) / ((F.col("good") + 0.1) / sizes[0])
    expected = sizes[1] / (sizes[0] + sizes[1])
    evidence = _times_log("bad", expected) + _times_log("good", 1.0 - expected)
    least = math.log(max(counted.count(), 1)) + MARGIN
    support = max(LEAST_DOCS, min(MOST_DOCS, LEAST_SHARE * sizes[1]))
    kept = (
        counted.filter((F.col("bad") >= support) & (lift >= LEAST_LIFT) & (evidence >= least))
        .orderBy((F.col("bad") * F.log(lift)).desc(), "term")
        .limit(TERMS)
        .collect()
    )
    if not kept:
        warnings.warn("no term stands out in toxic documents; every document counts as clean", stacklevel=2)
        return None
    terms = {r["term"]: i for i, r in enumerate(kept)}
    read = sample.select("toxic", "text").mapInArrow(_reading(terms), "toxic int, numbers array<int>, share double")
    rows = read.collect()  # at most ``bound`` short rows
    toxic = np.array([r["toxic"] for r in rows])
    share = np.array([r["share"] for r in rows])
    cuts = np.quantile(share[toxic == 1], [1 / 3, 2 / 3])
    grades = np.where(toxic == 1, 1 + np.searchsorted(cuts, share, side="left"), 0)
    size = len(terms) + SHARE_BINS
    present = [features(list(r["numbers"]), r["share"], len(terms)) for r in rows]
    weights, thresholds = fit_ordinal(present, grades, size)
    chance = np.array([1.0 - _sigmoid(thresholds[:1] - weights[p].sum())[0] if p else 0.0 for p in present])
    return Model(terms, weights, thresholds, best_cut(chance, toxic))


def best_cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The chance from which on calling a document toxic makes the fewest errors in the sample."""
    order = np.argsort(chance, kind="stable")
    ranked, bad = chance[order], toxic[order]
    # Errors if the first i rows are called clean.
    errors = np.r_[0, np.cumsum(bad)] + (len(bad) - bad.sum()) - np.r_[0, np.cumsum(1 - bad)]
    errors[1:-1] = np.where(ranked[1:] == ranked[:-1], len(bad) + 1, errors[1:-1])
    best = int(errors.argmin())
    low, high = ranked[best - 1] if best else 0.0, ranked[best] if best < len(ranked) else 1.0
    return float((low + high) / 2)


def _reading(terms: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in batches:
            found = [reader.read(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["toxic", "numbers", "share"],
            )

    return run


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``severity`` (expected grade), ``p_toxic`` and ``is_toxic`` for every row."""
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = narrow.schema["k"].dataType.simpleString()
    if model is None:
        zero = F.lit(0.0)
        return narrow.select(
            F.col("k").alias(key), zero.alias("severity"), zero.alias("p_toxic"), F.lit(False).alias("is_toxic")
        )
    # At most TERMS terms: a few hundred kilobytes.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, thresholds, cut = shared.value
        reader = Reader(terms)
        for batch in batches:
            severity, chance = [], []
            for value in batch.column(1):
                numbers, share = reader.read(value.as_py())
                if numbers:
                    total = weights[features(numbers, share, len(terms))].sum()
                    above = 1.0 - _sigmoid(thresholds - total)
                else:
                    above = np.zeros(GRADES - 1)
                severity.append(float(above.sum()))
                chance.append(float(above[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(severity, pa.float64()),
                    pa.array(chance, pa.float64()),
                    pa.array([c > cut for c in chance], pa.bool_()),
                ],
                ["k", "severity", "p_toxic", "is_toxic"],
            )

    return narrow.mapInArrow(run, f"k {kind}, severity double, p_toxic double, is_toxic boolean").withColumnRenamed("k", key)
