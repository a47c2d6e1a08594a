"""Language identification by interpolated Kneser-Ney character models.

*Alphabet.* Lower-cased letters of the sample are numbered by frequency; any other letter is one
unknown symbol, and a run of anything else is one break. A gram of up to four symbols is one
integer, and a multiplication turns it into its hash.

*Models.* Per language, four-grams use counts and lower orders the number of different symbols seen
before them; each order is discounted and interpolated with the next lower one, down to a uniform
chance. All grams seen in any language stand in one sorted hash array per order, with a column of
log chances per language; contexts stand in another with the weights of the lower orders. An
unseen gram takes the weight of its context and goes on with the order below, which is the same
value that interpolation gives.

*Decision.* The lowest cross-entropy per symbol wins; ties go to the first language in code point order.
``score`` is the winner's share under a softmax whose temperature fits a calibration part of the
sample. ``rejected`` tells that the winner's cross-entropy is above the ``QUANTILE`` of that language's own
texts in the calibration part.

The sample holds at most ``SAMPLE`` texts per language, taken by a hash of the key; every document is
scored as a whole.

Defined results: a null text or one without a letter is ``und`` with score 0; without anything to learn
from every text is; rows without a key are never learnt from and are not held out; repeated rows are
predicted alike; equal scores of two languages go to the first by name; a very long text is scored whole; an empty
table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.storage import materialise

ORDER = 4
#: Texts per language that the models are fitted on, at most; every fifth of them calibrates.
SAMPLE = 1500
CALIBRATION = 5
QUANTILE = 0.995
#: Bits of a symbol in a gram; letters beyond the alphabet are one unknown symbol.
SYMBOL_BITS = 12
BREAK, UNKNOWN, FIRST_LETTER = 1, 2, 3
UNDETERMINED = "und"
#: Characters that a task works on together.
GROUP_CHARS = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Order(NamedTuple):
    #: Sorted hashes of grams and, a row each, their log chances by language.
    grams: np.ndarray
    chances: np.ndarray
    #: Sorted hashes of contexts and the log weights they give to the order below.
    contexts: np.ndarray
    weights: np.ndarray


class Model(NamedTuple):
    languages: list[str]
    alphabet: dict[int, int]
    orders: list[Order]
    floor: float
    temperature: float
    limits: np.ndarray


def is_letter_table() -> np.ndarray:
    """For every code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def symbol_table(alphabet: dict[int, int]) -> np.ndarray:
    """For every code point its symbol."""
    table = np.where(is_letter_table(), UNKNOWN, BREAK).astype(np.uint16)
    for code, symbol in alphabet.items():
        table[code] = symbol
    return table


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of several texts, each after ``ORDER - 1`` breaks, and the text of each symbol (-1: pad)."""
    parts = [_code_points(t) for t in texts]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    raw = table[np.concatenate(parts)] if parts else np.zeros(0, np.uint16)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    gap = raw == BREAK
    again = np.zeros(len(raw), dtype=bool)
    again[1:] = gap[1:] & gap[:-1] & (owner[1:] == owner[:-1])
    first = np.cumsum(sizes) - sizes
    first = first[sizes > 0]
    again[first] |= gap[first]  # the pad already is a break
    keep = ~again
    raw, owner = raw[keep], owner[keep]
    pad = ORDER - 1
    out = np.full(len(raw) + pad * len(parts), BREAK, dtype=np.uint64)
    whose = np.full(len(out), -1, dtype=np.int32)
    at = np.arange(len(raw)) + pad * (owner.astype(np.int64) + 1)
    out[at] = raw
    whose[at] = owner
    return out, whose


def grams(out: np.ndarray, order: int) -> np.ndarray:
    """The gram that ends at each symbol from place ``ORDER - 1`` on."""
    stop = len(out)
    gram = np.zeros(max(stop - ORDER + 1, 0), dtype=np.uint64)
    for back in range(order - 1, -1, -1):
        gram = (gram << np.uint64(SYMBOL_BITS)) | out[ORDER - 1 - back : stop - back]
    return gram


def _hashed(gram: np.ndarray) -> np.ndarray:
    mixed = gram * _MIX
    return mixed ^ (mixed >> np.uint64(31))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted hash, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def log_chances(out: np.ndarray, orders: list[Order], floor: float, languages: int) -> np.ndarray:
    """Log chance of every symbol from place ``ORDER - 1`` on, a column per language."""
    n = max(len(out) - ORDER + 1, 0)
    result = np.zeros((n, languages), dtype=np.float32)
    left = None
    for order in range(ORDER, 0, -1):
        model = orders[order - 1]
        gram = grams(out, order)
        if left is not None:
            gram = gram[left]
        at = _find(model.grams, _hashed(gram))
        found = at >= 0
        if left is None:
            if found.all():
                return model.chances[at]
            result[found] = model.chances[at[found]]
            left = np.flatnonzero(~found)
        else:
            result[left[found]] += model.chances[at[found]]
            left = left[~found]
        if not len(left):
            return result
        context = _find(model.contexts, _hashed(gram[~found] >> np.uint64(SYMBOL_BITS)))
        seen = context >= 0
        result[left[seen]] += model.weights[context[seen]]
    result[left] += np.float32(floor)
    return result


def fit_orders(counts: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[list[Order], float]:
    """The interpolated orders from each language's four-grams and their counts."""
    bits, mask = np.uint64(SYMBOL_BITS), [np.uint64((1 << (SYMBOL_BITS * n)) - 1) for n in range(ORDER + 1)]
    # Per language and order: grams and how often they count there.
    tables: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for top, often in counts:
        own = [(top, often.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            below, number = np.unique(own[0][0] & mask[order], return_counts=True)
            own.insert(0, (below, number.astype(np.float64)))
        tables.append(own)
    floor = 1.0 / size
    lower_grams = np.zeros(1, dtype=np.uint64)
    lower = np.full((1, len(counts)), floor)
    orders: list[Order] = []
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([own[order - 1][0] for own in tables]))
        contexts = np.unique(union >> bits)
        chance = np.zeros((len(union), len(counts)))
        weight = np.ones((len(contexts), len(counts)))
        below = lower[np.searchsorted(lower_grams, union & mask[order - 1])]
        context_of = np.searchsorted(contexts, union >> bits)
        for k, own in enumerate(tables):
            gram, often = own[order - 1]
            ones, twos = (often == 1).sum(), (often == 2).sum()
            discount = ones / (ones + 2 * twos) if ones else 0.5
            place = np.searchsorted(contexts, gram >> bits)
            total = np.bincount(place, weights=often, minlength=len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            there = total > 0
            weight[there, k] = discount * kinds[there] / total[there]
            direct = np.zeros(len(union))
            direct[np.searchsorted(union, gram)] = np.maximum(often - discount, 0)
            chance[:, k] = direct / np.maximum(total, 1e-300)[context_of] * there[context_of]
            chance[:, k] += weight[context_of, k] * below[:, k]
        order_of = np.argsort(_hashed(union))
        context_order = np.argsort(_hashed(contexts))
        orders.append(
            Order(
                _hashed(union)[order_of],
                np.log(np.maximum(chance, 1e-30))[order_of].astype(np.float32),
                _hashed(contexts)[context_order],
                np.log(np.maximum(weight, 1e-30))[context_order].astype(np.float32),
            )
        )
        lower_grams, lower = union, chance
    return orders, float(np.log(floor))


def entropies(texts: list[str], table: np.ndarray, model_orders: list[Order], floor: float, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per symbol of each text by language, and whether the text has a letter."""
    out, whose = symbols(texts, table)
    whose = whose[ORDER - 1 :]
    chances = log_chances(out, model_orders, floor, languages)
    real = whose >= 0
    whose = whose[real]
    size = np.bincount(whose, minlength=len(texts))
    total = np.empty((len(texts), languages))
    for k in range(languages):
        total[:, k] = np.bincount(whose, weights=chances[real, k], minlength=len(texts))
    letters = np.bincount(whose, weights=out[ORDER - 1 :][real] != BREAK, minlength=len(texts)) > 0
    return -total / np.maximum(size, 1)[:, None], letters


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, key: str, text: str, lang: str, bound: int) -> DataFrame:
    """``lang, text, calibrates`` of at most ``bound`` texts per language, stored."""
    first = Window.partitionBy("lang").orderBy(F.xxhash64("k"), "k")
    learnt = docs.select(F.col(key).alias("k"), F.col(lang).alias("lang")).filter(
        F.col("k").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("k"))
    )
    # A share of each language that holds about twice the bound, so that no task ranks a whole language.
    sizes = learnt.groupBy("lang").agg(F.count("*").alias("n"))
    slices = 1 << 20
    share = F.pmod(F.xxhash64("lang", "k"), F.lit(slices)) * F.col("n") < 2 * bound * slices
    # One row per language, each of which the model has a column for.
    few = learnt.join(F.broadcast(sizes), "lang").filter(share).drop("n")
    chosen = few.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= bound)
    keys = materialise(chosen.select("k", F.col("lang").alias("l"), "place").dropDuplicates(["k", "l"]), "language-keys")
    texts = docs.select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # At most ``bound`` keys per language.
    met = texts.filter("text is not null").join(F.broadcast(keys), "k").filter("lang = l")
    return materialise(met.select("lang", "text", (F.col("place") % CALIBRATION == 0).alias("calibrates")), "language-sample")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = SAMPLE) -> Model | None:
    """The models of all languages, or None where there is nothing to learn from."""
    sample = _sample(docs, key, text, lang, bound)
    # The letters of a bounded sample.
    letters = (
        sample.select(F.explode(F.split(F.lower("text"), "")).alias("c"))
        .filter(F.col("c").rlike(r"^\p{L}$"))
        .groupBy("c")
        .count()
        .orderBy(F.col("count").desc(), "c")
        .limit((1 << SYMBOL_BITS) - FIRST_LETTER)
        .collect()
    )
    if not letters:
        return None
    alphabet = {ord(r["c"]): FIRST_LETTER + i for i, r in enumerate(letters)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table(alphabet)
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = np.array(batch.column(1).to_pylist(), dtype=object)
            for lang_ in sorted(set(langs)):
                out, whose = symbols(texts[langs == lang_].tolist(), table)
                gram, often = np.unique(grams(out, ORDER)[whose[ORDER - 1 :] >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang_] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(often)],
                    ["lang", "gram", "n"],
                )

    fitted = sample.filter(~F.col("calibrates")).select("lang", "text")
    rows = (
        fitted.mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    rows = rows.sort_values(["lang", "gram"])
    languages = sorted(rows["lang"].unique(), key=lambda x: x.encode())
    if not languages:
        return None
    counts = []
    for name in languages:
        own = rows[rows["lang"] == name]
        gram = own["gram"].to_numpy().view(np.uint64)
        order = np.argsort(gram)
        counts.append((gram[order], own["n"].to_numpy()[order]))
    orders, floor = fit_orders(counts, len(alphabet) + FIRST_LETTER)
    model = Model(languages, alphabet, orders, floor, 1.0, np.full(len(languages), np.inf))
    return _calibrated(sample.filter("calibrates").select("lang", "text"), model)


def _scored(model_of, keep: list[str]):
    """A task body that gives the cross-entropies of the text in column ``len(keep)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = model_of()
        table = symbol_table(model.alphabet)
        n = len(model.languages)
        for whole in batches:
            first, chars, texts = 0, 0, []
            for i, value in enumerate(whole.column(len(keep))):
                texts.append(value.as_py() or "")
                chars += len(texts[-1])
                if chars < GROUP_CHARS and i + 1 < whole.num_rows:
                    continue
                entropy, letters = entropies(texts, table, model.orders, model.floor, n)
                best = entropy.argmin(axis=1)
                at = np.arange(len(texts))
                low = entropy[at, best]
                shares = 1.0 / np.exp((low[:, None] - entropy) * model.temperature).sum(axis=1)
                part = whole.slice(first, i + 1 - first)
                names = np.array(model.languages, dtype=object)[best]
                names[~letters] = UNDETERMINED
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in range(len(keep))),
                        pa.array(names.tolist(), pa.string()),
                        pa.array(np.where(letters, shares, 0.0)),
                        pa.array(np.where(letters, low, 0.0)),
                        pa.array(letters & (low > model.limits[best])),
                        pa.array(entropy.tolist(), pa.list_(pa.float64())),
                    ],
                    [*keep, "lang_pred", "score", "entropy", "rejected", "entropies"],
                )
                first, chars, texts = i + 1, 0, []

    return run


_RESULT = "lang_pred string, score double, entropy double, rejected boolean, entropies array<double>"


def _calibrated(part: DataFrame, model: Model) -> Model:
    """The model with the temperature and the limits that fit a labelled part of the sample."""
    shared = part.sparkSession.sparkContext.broadcast(model)
    rows = part.mapInArrow(_scored(lambda: shared.value, ["lang"]), f"lang string, {_RESULT}").collect()
    number = {name: i for i, name in enumerate(model.languages)}
    rows = [r for r in rows if r["lang"] in number and r["lang_pred"] != UNDETERMINED]
    if not rows:
        return model
    truth = np.array([number[r["lang"]] for r in rows])
    entropy = np.array([r["entropies"] for r in rows])
    own = entropy[np.arange(len(rows)), truth]
    losses = []
    heats = 2.0 ** np.arange(-2, 8)
    for heat in heats:
        share = np.exp((entropy.min(axis=1, keepdims=True) - entropy) * heat)
        losses.append(-np.log(np.maximum((share / share.sum(axis=1, keepdims=True))[np.arange(len(rows)), truth], 1e-12)).mean())
    limits = np.array(
        [np.quantile(own[truth == k], QUANTILE) if (truth == k).any() else np.inf for k in range(len(number))]
    )
    return model._replace(temperature=float(heats[int(np.argmin(losses))]), limits=limits)


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``lang_pred``, ``score``, ``entropy`` and ``rejected`` of every row."""
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = narrow.schema["k"].dataType.simpleString()
    if model is None:
        found = narrow.select(
            "k",
            F.lit(UNDETERMINED).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(0.0).alias("entropy"),
            F.lit(False).alias("rejected"),
        )
    else:
        # Bounded by the sample: a few megabytes per language.
        shared = docs.sparkSession.sparkContext.broadcast(model)
        found = narrow.mapInArrow(_scored(lambda: shared.value, ["k"]), f"k {kind}, {_RESULT}")
    return found.select(
        F.col("k").alias(key), held_out(F.col("k")).alias("held_out"), "lang_pred", "score", "entropy", "rejected"
    )
