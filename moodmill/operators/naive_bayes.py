"""Naive Bayes as aggregations over the long term table.

All forms share one shape. A fitted model scores class ``c`` of a document as

    bias_c + unit_c * sum(x) + sum(x * w_c(term))

over its entries, where ``x`` is the value of an entry. ``unit_c`` is what a term
that the class never saw contributes, and ``w_c(term)`` is the surplus of a term that
it did see, so zero cells are never stored and a term outside the model costs nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import NO_BUCKET, NO_TERM
from ..storage import materialise
from .features import idf_plain, idf_smooth, real_terms
from .skew import count_hot_keys, hot_keys, join_per_term

CLASSES = (0, 1, 2)
TIE_DIGITS = 9


def count_by_class(entries: DataFrame, classes: Sequence[int], train: Column, *more: Column) -> DataFrame:
    """One row per term: ``df`` over all documents, ``df_c`` and ``tf_c`` over training ones, and ``more`` sums.

    One shuffle on the term after partial sums inside each task. The row of the extra
    entry holds the number of documents in all and in each class.
    """
    sums = []
    for c in classes:
        mine = train & (F.col("label") == c)
        sums.append(F.count_if(mine).alias(f"df_{c}"))
        sums.append(F.coalesce(F.sum(F.when(mine, F.col("tf"))), F.lit(0)).alias(f"tf_{c}"))
    return entries.groupBy("term").agg(F.count("*").alias("df"), *sums, *more)


def _extra_term(table: DataFrame) -> Column:
    return F.lit(NO_BUCKET if dict(table.dtypes)["term"] == "int" else NO_TERM)


@dataclass
class Counts:
    """The stored counts of one training run, and its class sizes."""

    table: DataFrame
    classes: tuple[int, ...]
    n_docs: dict[int, int]
    hot: DataFrame = field(repr=False)
    terms: DataFrame = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.terms = real_terms(self.table)

    @property
    def n_train(self) -> int:
        return sum(self.n_docs.values())

    @property
    def train_df(self) -> Column:
        return sum((F.col(f"df_{c}") for c in self.classes), F.lit(0))

    def log_prior(self, smoothing: float = 0.0) -> dict[int, float]:
        k = len(self.classes)
        total = self.n_train + k * smoothing
        return {c: math.log((self.n_docs[c] + smoothing) / total) for c in self.classes}


def count_training(
    entries: DataFrame,
    classes: Sequence[int] = CLASSES,
    train: Column | None = None,
) -> Counts:
    """Count once, store the counts, and keep the classes that have training documents."""
    train = F.col("split") == "train" if train is None else train
    return of_table(materialise(count_by_class(entries, classes, train), "counts"), classes)


def of_table(table: DataFrame, classes: Sequence[int] = CLASSES) -> Counts:
    """The counts in a stored table of ``count_by_class`` rows."""
    # One scan for the number of entries and the class sizes, which the extra entry's row holds.
    extra = F.col("term") == _extra_term(table)
    in_class = [F.max(F.when(extra, F.col(f"df_{c}"))).alias(f"n_{c}") for c in classes]
    sizes = table.agg(F.sum("df").alias("entries"), *in_class).first()
    n_docs = {c: sizes[f"n_{c}"] for c in classes if sizes[f"n_{c}"]}
    return Counts(table, tuple(n_docs), n_docs, hot_keys(table, sizes["entries"] or 0))


def training_vocabulary(counts: Counts) -> Counts:
    """The counts without terms that only other documents hold, so that nothing of these shows in a model.

    Score such a model with ``known_only``: a term that training never met is then left out.
    """
    return replace(counts, table=counts.table.filter(counts.train_df > 0))


@dataclass
class Model:
    """``columns`` over ``terms``: one ``w_c`` per class and, for tf-idf values, ``idf``."""

    classes: tuple[int, ...]
    bias: dict[int, float]
    unit: dict[int, float]
    terms: DataFrame
    columns: dict[str, Column]
    value: str = "count"
    unseen_idf: float | None = None
    unit_length: bool = False
    #: The hot terms of the texts to score; counted from their entries if not given.
    hot: DataFrame | None = field(default=None, repr=False)

    @property
    def weights(self) -> DataFrame:
        return self.terms.select("term", *[c.alias(name) for name, c in self.columns.items()])


def _multinomial(
    counts: Counts,
    masses: dict[int, Column],
    alpha: float,
    prior_smoothing: float = 0.0,
    vocabulary_size: int | None = None,
    idf: Column | None = None,
    **options,
) -> Model:
    # masses: the summed feature values of each class, over counts.terms; the vocabulary is
    # every row of counts.terms unless its size is given
    sums = [F.sum(mass).alias(f"s_{c}") for c, mass in masses.items()]
    totals = counts.terms.agg(F.count("*").alias("n_terms"), *sums).first()
    size = totals["n_terms"] if vocabulary_size is None else vocabulary_size
    unit = {c: math.log(alpha / ((totals[f"s_{c}"] or 0.0) + alpha * size)) for c in masses}
    columns = {f"w_{c}": F.log1p(mass / alpha) for c, mass in masses.items()}
    if idf is not None:
        columns["idf"] = idf
    return Model(
        counts.classes,
        counts.log_prior(prior_smoothing),
        unit,
        counts.terms,
        columns,
        hot=counts.hot,
        **options,
    )


def fit_counts(counts: Counts, alpha: float = 1.0) -> Model:
    """Multinomial on raw counts; the vocabulary is every term of the counted table."""
    return _multinomial(counts, {c: F.col(f"tf_{c}") for c in counts.classes}, alpha)


def fit_plain_tfidf(counts: Counts, num_features: int, alpha: float = 1.0) -> Model:
    """Multinomial on ``tf * idf`` of hash buckets, with a smoothed prior."""
    counts = training_vocabulary(counts)
    idf = idf_plain(counts.train_df, counts.n_train)
    masses = {c: idf * F.col(f"tf_{c}") for c in counts.classes}
    return _multinomial(
        counts,
        masses,
        alpha,
        prior_smoothing=alpha,
        vocabulary_size=num_features,
        idf=idf,
        value="tfidf",
        unseen_idf=math.log(counts.n_train + 1.0),
    )


def smooth_idf(counts: Counts) -> Column:
    return idf_smooth(counts.train_df, counts.n_train)


def smooth_idf_table(counts: Counts) -> DataFrame:
    return counts.terms.select("term", smooth_idf(counts).alias("idf"))


def with_unit_masses(
    counts: Counts, train_docs: DataFrame, entries: Callable[..., DataFrame]
) -> Counts:
    """The counts with ``u_c``, the summed tf-idf of unit-length documents, stored once more.

    ``entries(docs, *keep)`` unfolds the documents that ``counts`` counted as training ones to term rows. The join
    with the IDF table gives the length of each document, one number for its key. A share is ``tf * idf / length``
    and the IDF is one for a term, so ``tf / length`` is summed by term from the documents themselves, after
    partial sums in each task: no weighted row travels to its document and back.
    """
    frequent = counts.terms.filter(counts.train_df > 1).select("term", smooth_idf(counts).alias("idf"))
    lengths = document_lengths(frequent, counts.n_train, counts.hot, train_docs, entries)
    measured = train_docs.join(lengths, F.col("doc_id").eqNullSafe(F.col("_key")))
    shares = real_terms(entries(measured, "label", "length"))
    in_class = {c: F.when(F.col("label") == c, F.col("tf") / F.col("length")) for c in counts.classes}
    sums = shares.groupBy("term").agg(*[F.sum(e).alias(f"s_{c}") for c, e in in_class.items()])
    # Terms without training documents keep a row: they count as known and weigh nothing.
    idf = smooth_idf(counts)
    masses = [(F.coalesce(F.col(f"s_{c}"), F.lit(0.0)) * idf).alias(f"u_{c}") for c in counts.classes]
    joined = counts.table.join(sums, "term", "left")
    return replace(counts, table=materialise(joined.select(counts.table["*"], *masses), "masses"))


def document_lengths(
    frequent: DataFrame, n_train: int, hot: DataFrame, train_docs: DataFrame, entries: Callable[..., DataFrame]
) -> DataFrame:
    """``_key, length`` of the tf-idf of each training document, stored.

    ``frequent`` has the IDF of the terms of more than one training document; a term of a training document that is
    in no row of it has a training frequency of one.
    """
    weighted = join_per_term(real_terms(entries(train_docs)), frequent, hot)
    weight = F.col("tf") * F.coalesce("idf", idf_smooth(F.lit(1), n_train))
    square = F.sum(weight * weight)
    found = weighted.groupBy(F.col("doc_id").alias("_key")).agg(F.sqrt(square).alias("length"))
    # A stored narrow table, so Spark decides by its size whether documents move to their lengths.
    return materialise(found, "document-lengths")


def count_unit_training(
    docs: DataFrame, entries: Callable[..., DataFrame], classes: Sequence[int] = CLASSES
) -> Counts:
    """``count_training`` and ``with_unit_masses`` of the documents, with the wide rows of a term summed and stored once.

    Lengths need the IDF alone, so a first pass counts training documents by term and keeps the terms that occur in
    more than one. The second counts everything, masses among it, when the lengths are known: no table with a row
    for each term is joined with another.
    """
    train = F.col("split") == "train"
    train_docs, others = docs.filter(train), docs.filter(F.coalesce(~train, F.lit(True)))
    counted = entries(train_docs, "label").groupBy("term").agg(F.count_if(F.col("label").isin(*classes)).alias("df"))
    extra = F.col("term") == _extra_term(counted)
    # The extra entry's row stays, whatever its frequency: it is the number of training documents.
    found = materialise(counted.filter((F.col("df") > 1) | extra), "frequent-terms")
    sizes = found.agg(F.sum("df").alias("entries"), F.max(F.when(extra, F.col("df"))).alias("n_train")).first()
    n_train = sizes["n_train"] or 0
    frequent = real_terms(found).select("term", idf_smooth(F.col("df"), n_train).alias("idf"))
    lengths = document_lengths(frequent, n_train, hot_keys(found, sizes["entries"] or 0), train_docs, entries)

    measured = train_docs.join(lengths, F.col("doc_id").eqNullSafe(F.col("_key")), "left").drop("_key")
    every = measured.unionByName(others.withColumn("length", F.lit(None).cast("double")))
    # Test documents have no length.
    in_class = {c: F.when(F.col("label") == c, F.col("tf") / F.col("length")) for c in classes}
    shares = [F.sum(e).alias(f"s_{c}") for c, e in in_class.items()]
    table = count_by_class(entries(every, "label", "split", "length"), classes, train, *shares)
    idf = idf_smooth(sum((F.col(f"df_{c}") for c in classes), F.lit(0)), n_train)
    # Terms without training documents keep a row: they count as known and weigh nothing.
    masses = {c: F.when(~extra, F.col(f"s_{c}") * idf) for c in classes}
    kept = [c for c in table.columns if not c.startswith("s_")]
    wide = table.select(*kept, *[F.coalesce(m, F.lit(0.0)).alias(f"u_{c}") for c, m in masses.items()])
    return of_table(materialise(wide, "masses"), classes)


def fit_unit_tfidf(counts: Counts, score_on: str = "count", alpha: float = 1.0) -> Model:
    """Multinomial on ``with_unit_masses`` counts, scored on term counts or on tf-idf."""
    masses = {c: F.col(f"u_{c}") for c in counts.classes}
    on_tfidf = {"value": "tfidf", "unit_length": True} if score_on == "tfidf" else {}
    return _multinomial(counts, masses, alpha, idf=smooth_idf(counts), **on_tfidf)


def fit_bernoulli(counts: Counts, alpha: float = 1.0) -> Model:
    """Presence of terms only; an absent term counts against the class that usually has it."""
    probability = {
        c: (F.col(f"df_{c}") + alpha) / (counts.n_docs[c] + 2.0 * alpha) for c in counts.classes
    }
    absent = counts.terms.agg(
        *[F.sum(F.log(1.0 - p)).alias(f"a_{c}") for c, p in probability.items()]
    ).first()
    prior = counts.log_prior()
    return Model(
        counts.classes,
        {c: prior[c] + (absent[f"a_{c}"] or 0.0) for c in counts.classes},
        {c: 0.0 for c in counts.classes},
        counts.terms,
        {f"w_{c}": F.log(p) - F.log(1.0 - p) for c, p in probability.items()},
        value="presence",
        hot=counts.hot,
    )


def log_likelihoods(model: Model) -> DataFrame:
    """``term`` and ``logp_c`` per class: the usual table of a multinomial model."""
    return model.weights.select(
        "term", *[(F.col(f"w_{c}") + model.unit[c]).alias(f"logp_{c}") for c in model.classes]
    )


def score_all(
    models: Mapping[str, Model], entries: DataFrame, keep: Sequence[str], known_only: bool = False
) -> DataFrame:
    """``keep`` columns (``doc_id`` first) and ``<name>score_<c>`` for every model and class.

    All models are scored in one join of the entries with their weights side by side; models
    fitted from the same counts read one table. With ``known_only`` a term that has no weight
    row is ignored; otherwise it counts as a term that no class has seen. Set ``hot`` to None
    in a model that meets other texts than it was trained on: their entries are then counted
    first, so hand over entries of a stored table.
    """
    weights, tables = None, {id(m.terms): m.terms for m in models.values()}
    for key, table in tables.items():
        columns = [
            column.alias(f"{name}{alias}")
            for name, m in models.items()
            if id(m.terms) == key
            for alias, column in m.columns.items()
        ]
        part = table.select("term", *columns)
        weights = part if weights is None else weights.join(part, "term", "full")
    any_model = next(iter(models.values()))
    hot = count_hot_keys(entries) if any_model.hot is None else any_model.hot
    joined = join_per_term(entries, weights, hot)
    real = F.col("term") != _extra_term(entries)

    values, sums, scores = [], [], []
    for name, model in models.items():
        counted = real
        if known_only:
            counted = real & F.col(f"{name}w_{model.classes[0]}").isNotNull()
        if model.value == "tfidf":
            idf = F.col(f"{name}idf")
            if model.unseen_idf is not None:
                idf = F.coalesce(idf, F.lit(model.unseen_idf))
            value = F.col("tf") * idf
        else:
            value = F.lit(1) if model.value == "presence" else F.col("tf")
        x = F.col(f"{name}x")
        values.append(F.when(counted, value.cast("double")).otherwise(0.0).alias(f"{name}x"))
        sums.append(F.sum(x).alias(f"{name}x"))
        length = F.lit(1.0)
        if model.unit_length:
            sums.append(F.sum(x * x).alias(f"{name}xx"))
            length = F.when(F.col(f"{name}xx") > 0, F.sqrt(f"{name}xx")).otherwise(1.0)
        for c in model.classes:
            weight = F.coalesce(f"{name}w_{c}", F.lit(0.0))
            sums.append(F.sum(x * weight).alias(f"{name}sum_{c}"))
            total = model.unit[c] * x + F.col(f"{name}sum_{c}")
            scores.append((model.bias[c] + total / length).alias(f"{name}score_{c}"))
    weight_columns = [c for c in weights.columns if c != "term"]
    per_doc = joined.select(*keep, *weight_columns, *values).groupBy(*keep).agg(*sums)
    return per_doc.select(*keep, *scores)


def best_class(scores: DataFrame, classes: Sequence[int], name: str = "") -> DataFrame:
    """Add ``<name>prediction``: the class with the highest score, the lowest one on a tie."""
    ranked = F.array_max(
        F.array(
            *[
                F.struct(
                    F.round(f"{name}score_{c}", TIE_DIGITS).alias("score"), F.lit(-c).alias("order")
                )
                for c in classes
            ]
        )
    )
    return scores.withColumn(f"{name}prediction", -ranked["order"])


KEEP = ("doc_id", "label", "split")


def predict(
    model: Model, entries: DataFrame, keep: Sequence[str] = KEEP, known_only: bool = False
) -> DataFrame:
    return best_class(score_all({"": model}, entries, keep, known_only), model.classes)


def predict_all(
    models: Mapping[str, Model], entries: DataFrame, keep: Sequence[str] = KEEP, known_only: bool = False
) -> DataFrame:
    """``keep`` columns and ``<name>_prediction`` of every model."""
    models = {f"{name}_": model for name, model in models.items()}
    scored = score_all(models, entries, keep, known_only)
    for name, model in models.items():
        scored = best_class(scored, model.classes, name)
    return scored.select(*keep, *[f"{name}prediction" for name in models])
