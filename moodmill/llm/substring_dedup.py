"""Long repeated passages: places chosen by recompression rounds, names shared around them, and a check.

A window of ``WINDOW`` words is repeated if its words also start anywhere else in the corpus; every
word under a repeated window is removed.

*Rounds.* The words of a text are its first symbols. A round names runs of two equal symbols, and two
further rounds name pairs whose left symbol is of the left and whose right symbol is of the right
half of all names. Names are hashes of what they stand for, so equal stretches get equal names in
every task without a shared dictionary. Where a symbol begins depends on ``REACH`` words to either
side, so equal windows have the same symbols inside that margin, and since a symbol spans at most
``SPAN`` words there always is one.

A fourth round would lose that: its symbols depend on 16 words to either side and span up to 16, more than a
window. After three a symbol spans 2 to 3 words on average, and nearly all are shared. So symbols choose
places, and longer names reveal repeats.

*Names around places.* Doubling names of 2, 4, 8 and 16 words name the surroundings of a symbol start.
Each window keeps the start of least name in its interior; these anchors, about one in ten words, go
through Spark, which finds those that two texts, or two places of a text, share. Every repeated
window keeps the same anchor in all its places, so none is lost.

*Check.* Only windows around shared anchors are compared, by two 64-bit names of all their words, which are
built from different hashes of the words.

Texts equal as a whole are one entry of the check: all their words are removed if there is a
window. So a group of copies, however large, sends one text. Sums and least values are merged
before they travel, and joins on common anchors or windows are left to adaptive skew splitting.

Defined results: a null text has no words; texts shorter than a window keep all words; repeated rows
are copies of each other; a very long text is read whole; ties do not arise; an empty table gives an empty table; null keys
are kept as they are; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodmill.storage import materialise

WINDOW = 35
#: Words to either side that decide where a symbol of the last round begins, and its longest span.
REACH = 8
SPAN = 8
#: Words of the doubling name of an anchor: REACH to either side of its start.
AROUND = 16

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD1, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_HALF = np.uint64(32)


def _name(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    """The name of each pair."""
    x = (left + np.uint64(seed)) * _ODD1
    x ^= x >> _HALF
    x += right
    x *= _ODD2
    x ^= x >> np.uint64(29)
    x *= _ODD1
    x ^= x >> _HALF
    return x


def _merge(symbols: np.ndarray, starts: np.ndarray, left: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Name the pairs whose left part is marked; marks never touch."""
    named = symbols.copy()
    at = np.flatnonzero(left)
    named[at] = _name(symbols[at], symbols[at + 1], seed)
    keep = np.ones(len(symbols), dtype=bool)
    keep[at + 1] = False
    return named[keep], starts[keep]


def symbol_starts(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Places where a symbol of the last round begins; ``text_of`` tells the texts apart."""
    symbols, starts = words, np.arange(len(words))
    if len(words) < 2:
        return starts
    # Runs of exactly two equal symbols.
    same = (symbols[1:] == symbols[:-1]) & (text_of[1:] == text_of[:-1])
    padded = np.r_[False, same, False]
    pair = padded[1:-1] & ~padded[:-2] & ~padded[2:]
    symbols, starts = _merge(symbols, starts, np.r_[pair, False], 1)
    for seed in (2, 3):
        if len(symbols) < 2:
            break
        side = (_name(symbols, symbols, seed + 10) >> np.uint64(63)).astype(bool)
        text = text_of[starts]
        pair = ~side[:-1] & side[1:] & (text[1:] == text[:-1])
        symbols, starts = _merge(symbols, starts, np.r_[pair, False], seed)
    return starts


def _doubled(names: np.ndarray, width: int, step: int, seed: int) -> np.ndarray:
    """Names of stretches of ``width + step`` words from names of ``width`` words, by place."""
    if len(names) <= step:
        return names[:0]
    return _name(names[:-step], names[step:], seed + width)


def stretch_names(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The name of the ``width`` words from each place on, by doubling."""
    names, have = words, 1
    while have < width:
        step = min(have, width - have)
        names = _doubled(names, have, step, seed)
        have += step
    return names


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each stretch of ``width`` values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


def anchors(words: np.ndarray, text_of: np.ndarray, text_start: np.ndarray, text_stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the anchors of several texts laid end to end."""
    n = len(words)
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if n < WINDOW:
        return none
    around = stretch_names(words, AROUND, 100)
    place = symbol_starts(words, text_of)
    begin, end = text_start[text_of[place]], text_stop[text_of[place]]
    place = place[(place - REACH >= begin) & (place + REACH <= end)]
    rank = np.full(n, _NONE)
    rank[place] = around[place - REACH] >> np.uint64(1)
    # Starts inside a window: from REACH words after its first to REACH words before its end.
    width = WINDOW - 2 * REACH + 1
    least = _sliding(rank[REACH:], width, np.minimum)[: n - WINDOW + 1]
    whole = text_of[: n - WINDOW + 1] == text_of[WINDOW - 1 :]
    least = np.where(whole, least, np.uint64(0))
    # A start is kept if some window around it has it as its least one.
    padded = np.zeros(n + 2 * WINDOW, dtype=np.uint64)
    padded[WINDOW : WINDOW + len(least)] = least
    highest = _sliding(padded, width, np.maximum)
    # Windows that may keep place p start at p - (WINDOW - REACH) up to p - REACH.
    kept = place[highest[place - (WINDOW - REACH) + WINDOW] == rank[place]]
    return kept, rank[kept]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class _Batch:
    """The word names of a batch of texts, end to end."""

    def __init__(self, texts: list[list[bytes]]) -> None:
        self.texts = texts
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.stop = np.cumsum(sizes)
        self.start = self.stop - sizes
        self.text_of = np.repeat(np.arange(len(texts)), sizes)
        self.words = self.hashed(0)
        self.place, self.name = anchors(self.words, self.text_of, self.start, self.stop)
        self.owner = self.text_of[self.place]

    def hashed(self, seed: int) -> np.ndarray:
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(w, seed) for t in self.texts for w in t), dtype=np.uint64, count=len(self.text_of))


#: Characters of texts that are worked on together.
_GROUP_CHARS = 1 << 23


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of a batch with the words of their texts."""
    first, chars, texts = 0, 0, []
    for i, value in enumerate(batch.column(column)):
        text = value.as_py()
        texts.append(_words(text))
        chars += len(text or "")
        if chars >= _GROUP_CHARS or i + 1 == batch.num_rows:
            yield batch.slice(first, i + 1 - first), texts
            first, chars, texts = i + 1, 0, []


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch, texts in _groups(whole, 2):
            laid = _Batch(texts)
            bounds = np.searchsorted(laid.owner, np.arange(len(texts) + 1))
            once, again = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                names, count = np.unique(laid.name[a:b], return_counts=True)
                once.append(names.view(np.int64))
                again.append(names[count > 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(t)).digest() for t in texts], pa.binary()),
                    pa.array(once, pa.list_(pa.int64())),
                    pa.array(again, pa.list_(pa.int64())),
                ],
                ["k", "key", "n_words", "sha", "once", "again"],
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows around shared anchors with both halves of their names."""
    for whole in batches:
        for batch, texts in _groups(whole, 1):
            laid = _Batch(texts)
            names = [stretch_names(words, WINDOW, 1000) for words in (laid.words, laid.hashed(1))]
            bounds = np.searchsorted(laid.owner, np.arange(len(texts) + 1))
            starts, high, low = [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                shared = np.array(batch.column(2)[i].as_py(), dtype=np.int64).view(np.uint64)
                hit = laid.place[a:b][np.isin(laid.name[a:b], shared)]
                first, last = int(laid.start[i]), int(laid.stop[i]) - WINDOW
                change = np.zeros(last - first + 2, dtype=np.int64) if last >= first else np.zeros(1, np.int64)
                np.add.at(change, np.clip(hit - (WINDOW - REACH), first, None) - first, 1)
                np.add.at(change, np.minimum(hit - REACH, last) + 1 - first, -1)
                at = np.flatnonzero(np.cumsum(change)[:-1] > 0)
                starts.append(at.astype(np.int32))
                high.append(names[0][first + at].view(np.int64))
                low.append(names[1][first + at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(high, pa.list_(pa.int64())),
                    pa.array(low, pa.list_(pa.int64())),
                ],
                ["key", "text", "starts", "high", "low"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of the texts once the words under these windows are removed."""
    for batch in batches:
        removed, digests = [], []
        for text, starts in zip(batch.column(1), batch.column(2), strict=True):
            words = _words(text.as_py())
            change = np.zeros(len(words) + 1, dtype=np.int64)
            at = np.array(starts.as_py(), dtype=np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
            covered = np.cumsum(change)[:-1] > 0
            left = b" ".join(w for w, gone in zip(words, covered.tolist(), strict=True) if not gone)
            removed.append(int(covered.sum()))
            digests.append(hashlib.sha256(left).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(digests, pa.binary())],
            ["key", "n_removed", "left_sha"],
        )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(key).alias("k"), F.unhex(F.md5(body)).alias("key"), body.alias("text"))
    kind = narrow.schema["k"].dataType.simpleString()
    described = materialise(
        narrow.mapInArrow(
            _describe,
            f"k {kind}, key binary, n_words bigint, sha binary, once array<bigint>, again array<bigint>",
        ),
        "repeat-anchors",
    )
    long = described.filter(F.col("n_words") >= WINDOW)
    copies = materialise(
        long.groupBy("key").agg(F.count("*").alias("copies"), F.min("k").alias("first")), "repeat-copies"
    )
    # An anchor is shared if two different texts have it, or one has it twice.
    half = F.xxhash64("key").alias("half")
    seen = long.select(half, F.explode("once").alias("name"), F.lit(False).alias("twice")).unionByName(
        long.select(half, F.explode("again").alias("name"), F.lit(True).alias("twice"))
    )
    # Stored, as an aggregation right below a join would keep Spark from splitting its common keys.
    shared = materialise(
        seen.groupBy("name")
        .agg(F.min("half").alias("a"), F.max("half").alias("b"), F.max("twice").alias("twice"))
        .filter("twice or a <> b")
        .select("name"),
        "repeat-shared",
    )
    flagged = (
        long.select("key", F.explode("once").alias("name"))
        .join(shared, "name", "left_semi")
        .groupBy("key")
        .agg(F.collect_set("name").alias("names"))
    )
    # One text of each group of copies stands for all of them.
    chosen = materialise(flagged.join(copies.select("key", "first"), "key"), "repeat-texts")
    windows = materialise(
        narrow.join(chosen.select("key", "first", "names"), "key")
        .filter(F.col("k").eqNullSafe(F.col("first")))
        .select("key", "text", "names")
        .mapInArrow(_windows, "key binary, text string, starts array<int>, high array<bigint>, low array<bigint>"),
        "repeat-windows",
    )
    placed = windows.select("key", F.inline(F.arrays_zip("starts", "high", "low")))
    repeated = materialise(
        placed.groupBy("high", "low").count().filter("count > 1").select("high", "low"), "repeat-names"
    )
    starts = (
        placed.join(repeated, ["high", "low"], "left_semi")
        .groupBy("key")
        .agg(F.collect_list("starts").alias("starts"))
    )
    cut = (
        windows.select("key", "text")
        .join(starts, "key")
        .select("key", "text", "starts")
        .mapInArrow(_cut, "key binary, n_removed bigint, left_sha binary")
    )
    whole = copies.filter("copies > 1").select("key")
    fate = (
        cut.join(whole, "key", "left_anti")
        .withColumn("gone", F.lit(False))
        .unionByName(
            whole.select(
                "key",
                F.lit(0).cast("long").alias("n_removed"),
                F.unhex(F.sha2(F.lit(""), 256)).alias("left_sha"),
                F.lit(True).alias("gone"),
            )
        )
    )
    removed = F.when(F.col("gone"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return described.select("k", "key", "n_words", "sha").join(fate, "key", "left").select(
        F.col("k").alias(key),
        "n_words",
        removed.alias("n_removed"),
        F.lower(F.hex(F.coalesce("left_sha", "sha"))).alias("kept_sha256"),
    )
