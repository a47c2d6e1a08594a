"""Packing documents into fixed-length sequences as a cutting-stock problem.

*Pieces.* A document longer than a sequence is cut after every full sequence; what remains, and any
shorter document, is one piece. Where a document is cut depends on its length alone, so the ids
are needed once, in the pass that counts and checks them.

*Patterns.* Lengths, rounded up to ``grain``, form a histogram of at most ``capacity / grain``
classes; it is the only thing the driver sees. Column generation solves the linear program "fewest
sequences that hold every class": duals of the current basis price the classes, a knapsack by
dynamic programming finds the pattern of highest price, and it enters the basis until none is
worth more than a sequence. Counts are rounded down, and what is left over is put into further
patterns first-fit, longest first.

*Assignment.* Pieces are ranked inside their class (by buckets of a row number, so that a class
with a third of all rows is no single task) and the rank picks the pattern, the copy of it and
the sequence. Offsets are running sums inside a sequence.

Defined results: a null text is an empty one and holds the end id only; repeated rows are packed
one by one; an empty table gives an empty table; columns of the input other than key and text are
not looked at; a very long text is cut into as many pieces as it needs. Ties of length go by row number of the stored table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodmill.llm.token_ids import encoder
from moodmill.storage import materialise

CAPACITY = 2048
#: Tokens that lengths are rounded up to in the histogram.
GRAIN = 8
END_ID = 1
#: Groups that the pieces of one length class are ranked in.
BUCKETS = 1024
#: A pattern enters the basis if it is worth this much more than a sequence; when none is, the
#: program is within this share of its optimum.
TOLERANCE = 5e-4
MAX_COLUMNS = 20_000


def pieces(docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """``k``, ``doc_tokens`` and ``pieces`` (start, length, crc of the ids) of every row."""
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = narrow.schema["k"].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()
    piece_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keeps_space=False)
        for batch in batches:
            counts, cut = [], []
            for encoded in encode(value.as_py() for value in batch.column(1)):
                ids = encoded + end
                total = len(ids) // 4
                counts.append(total)
                cut.append(
                    [
                        {"start": at, "length": min(capacity, total - at), "crc": zlib.crc32(ids[4 * at : 4 * (at + capacity)])}
                        for at in range(0, total, capacity)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(cut, piece_type)],
                ["k", "doc_tokens", "pieces"],
            )

    return narrow.mapInArrow(
        run,
        f"k {kind}, doc_tokens bigint, pieces array<struct<start:bigint,length:bigint,crc:bigint>>",
    )


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the counts of the classes worth most within the capacity."""
    value = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    ranked, worth = sizes[order], prices[order]
    fits = np.searchsorted(ranked, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if fits[room]:
            offers = value[room - ranked[: fits[room]]] + worth[: fits[room]]
            best = int(offers.argmax())
            if offers[best] > value[room] + 1e-12:
                value[room], taken[room] = offers[best], best
    counts = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            counts[order[taken[room]]] += 1
            room -= int(ranked[taken[room]])
    return float(value[capacity]), counts


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows of class counts) and how often each is used, enough for all of the demand."""
    n = len(sizes)
    fitting = capacity // sizes
    basis = np.diag(fitting).astype(np.float64)
    inverse = np.diag(1.0 / fitting)
    amount = demand / fitting
    for _ in range(MAX_COLUMNS):
        worth, column = best_pattern(sizes, inverse.sum(axis=0), capacity)
        if worth <= 1 + TOLERANCE:
            break
        direction = inverse @ column
        ratio = np.where(direction > 1e-11, amount / np.where(direction > 1e-11, direction, 1), np.inf)
        leaves = int(ratio.argmin())
        step = ratio[leaves]
        amount = amount - step * direction
        amount[leaves] = step
        amount = np.maximum(amount, 0)
        basis[:, leaves] = column
        row = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, row)
        inverse[leaves] = row
    used = np.floor(amount + 1e-9).astype(np.int64)
    patterns = basis.T.astype(np.int64)
    left = demand - used @ patterns
    # Patterns may hold more than is wanted of a class; what is still wanted goes first-fit.
    room: list[int] = []
    bins: list[np.ndarray] = []
    for item in np.argsort(-sizes, kind="stable"):
        for _ in range(max(0, int(left[item]))):
            place = next((b for b, free in enumerate(room) if free >= sizes[item]), None)
            if place is None:
                place = len(room)
                room.append(capacity)
                bins.append(np.zeros(n, dtype=np.int64))
            room[place] -= int(sizes[item])
            bins[place][item] += 1
    patterns = np.vstack([patterns[used > 0], *(b[None, :] for b in bins)])
    used = np.r_[used[used > 0], np.ones(len(bins), dtype=np.int64)]
    return patterns, used


def _slots(patterns: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
    """For each (class, pattern): the first rank it serves, items per sequence, first sequence."""
    first = np.r_[0, np.cumsum(used)[:-1]]
    columns: dict[str, list[int]] = {"item": [], "rank": [], "each": [], "sequence": []}
    for item in range(patterns.shape[1]):
        rank = 0
        for p in np.flatnonzero(patterns[:, item]):
            columns["item"].append(item)
            columns["rank"].append(rank)
            columns["each"].append(int(patterns[p, item]))
            columns["sequence"].append(int(first[p]))
            rank += int(patterns[p, item] * used[p])
    return {k: np.array(v, dtype=np.int64) for k, v in columns.items()}


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    grain: int = GRAIN,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per piece with its place in a sequence."""
    cut = pieces(docs, key, text, tokenizer, end_id, capacity)
    stored = materialise(cut.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    flat = stored.select(
        "k",
        "rid",
        "doc_tokens",
        F.inline("pieces"),
    ).withColumn("size", F.ceil(F.col("length") / grain).cast("int"))
    flat = flat.withColumn("bucket", F.pmod(F.xxhash64("rid", "start"), F.lit(buckets)).cast("int"))
    counts = materialise(flat.groupBy("size", "bucket").count(), "piece-counts")
    # At most capacity / grain rows, whatever the input.
    histogram = counts.groupBy("size").agg(F.sum("count").alias("n")).orderBy("size").collect()
    sizes = np.array([r["size"] for r in histogram], dtype=np.int64)
    demand = np.array([r["n"] for r in histogram], dtype=np.int64)
    if len(sizes):
        patterns, used = solve_patterns(sizes, demand, capacity // grain)
    else:
        patterns, used = np.zeros((0, 0), dtype=np.int64), np.zeros(0, dtype=np.int64)
    slots = _slots(patterns, used)
    span = int(demand.sum()) + 1
    edges = slots["item"] * span + slots["rank"]

    @F.pandas_udf("bigint")
    def sequence_of(size: pd.Series, rank: pd.Series) -> pd.Series:
        item = np.searchsorted(sizes, size.to_numpy())
        ranks = rank.to_numpy()
        slot = np.searchsorted(edges, item * span + ranks, side="right") - 1
        return pd.Series(slots["sequence"][slot] + (ranks - slots["rank"][slot]) // slots["each"][slot])

    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("size", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("size", "bucket").orderBy("rid", "start")
    ranked = flat.join(bases, ["size", "bucket"]).withColumn(
        "rank", F.col("base") + F.row_number().over(inside) - 1
    )
    placed = ranked.withColumn("sequence_id", sequence_of("size", "rank"))
    in_sequence = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("length").desc(), "rid", "start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        F.col("k").alias(key),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(in_sequence), F.lit(0)).alias("offset"),
    )
