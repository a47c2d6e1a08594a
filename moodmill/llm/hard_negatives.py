"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

*Rows.* ``(id, label, v)`` with integer components; a score is the integer inner product with the anchor, higher
first, ties to the smaller id. An anchor's positives are its first rows of the same label; the score of
a positive opens a window, a share of it to another share, from which the first rows of other labels
are taken.

*Lists.* Rows are dealt by hash to shards of about ``shard_rows``, each vector length on its own. A shard
keeps, for every dimension, its rows in the order of that component. The index is a table of one row per shard.

*Search.* An anchor reads each list from its high end where its own component is positive and from its low
end where it is negative (a zero component needs no list), in steps that double. Rows met for the first time
are scored exactly by random access. The threshold is the score of the values last read; nothing unread can be
above it. A window is finished when the threshold is strictly below the score of its k-th row, or below the window;
strictly, because an unread row of equal score could have a smaller id. A shard whose first threshold is
below all windows is left unread. Shard results are exact, so merging the first k of each is exact.

*Work.* The contract asks for every anchor against every row. A cell is one shard and one block of
anchors; a task holds one shard and reads the anchors of the block as a stream. Moved are the
shards once per block and the anchors once per shard; both sizes are parameters. In many dimensions the threshold
falls slowly, and most rows of a shard are read before it stops.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component take no part; only
vectors of equal length are compared, and empty ones score 0; rows equal in id, label and vector are one row, and no
row with the anchor's own id is its positive; an anchor without positives, or whose windows are empty, has no
rows; an empty table gives an empty table; other columns, whatever their names, are not read. There are no texts.
Scores must fit a long: a component beyond 2**25 after scaling is refused with an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.storage import materialise

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A window in hundredths of the positive's score.
WINDOW = (30, 90)
SHARD_ROWS = 16_384
BLOCK_ANCHORS = 256
#: Entries of each list read in the first step.
FIRST_STEP = 32
LIMIT = 1 << 25


class Lists(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    #: ``values[row, dimension]``, ``order[dimension]`` the rows by rising component, ``ranked`` those components.
    values: np.ndarray
    order: np.ndarray
    ranked: np.ndarray


def build(ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> Lists:
    order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T.astype(np.int32))
    ranked = np.take_along_axis(values.T, order, axis=1)
    return Lists(ids, labels, values, order, ranked)


def of_label(lists: Lists, label: int) -> Lists:
    mine = lists.labels == label
    return build(lists.ids[mine], lists.labels[mine], lists.values[mine])


def exact_type(dimensions: int, anchor_peak: int, row_peak: int) -> type:
    """The fastest number type in which every partial sum of an inner product is exact."""
    reach = dimensions * anchor_peak * row_peak
    return np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64


def first_rows(
    lists: Lists, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple[float, float]], k: int
) -> list[list[tuple[int, int]]]:
    """The first ``k`` ``(id, score)`` among ``wanted`` rows for each window of scores, ends included."""
    n = len(lists.ids)
    used = np.flatnonzero(anchor)
    signed = anchor[used]
    up = signed > 0
    seen = np.zeros(n, dtype=bool)
    places, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def threshold(depth: int) -> int:
        ends = np.where(up, n - 1 - depth, depth)
        return int(signed @ lists.ranked[used, ends].astype(np.int64))

    def score(rows: np.ndarray) -> None:
        nonlocal places, scores
        kind = lists.values.dtype
        found = (lists.values[rows] @ anchor.astype(kind)).astype(np.int64)
        places, scores = np.concatenate([places, rows]), np.concatenate([scores, found])

    def finished(window: tuple[float, float], bar: int) -> bool:
        low, high = window
        if bar < low:
            return True
        inside = scores[(scores >= low) & (scores <= high)]
        return len(inside) >= k and bar < np.partition(inside, len(inside) - k)[len(inside) - k]

    if len(used) == 0:
        score(np.flatnonzero(wanted))
    elif n:
        depth, step, bar = 0, FIRST_STEP, threshold(0)
        while depth < n and not all(finished(w, bar) for w in windows):
            stop = min(n, depth + step)
            read = [
                lists.order[d, n - stop : n - depth] if rising else lists.order[d, depth:stop]
                for d, rising in zip(used, up, strict=True)
            ]
            before = seen.copy()
            seen[np.concatenate(read)] = True
            score(np.flatnonzero(seen & ~before & wanted))
            depth, step = stop, step * 2
            bar = threshold(depth - 1)

    results = []
    for low, high in windows:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        order = np.lexsort((lists.ids[places[inside]], -scores[inside]))[:k]
        results.append([(int(lists.ids[places[i]]), int(scores[i])) for i in inside[order]])
    return results


def window_of(score: int, shares: tuple[int, int] = WINDOW) -> tuple[int, int]:
    """The integer scores from which negatives of a positive are taken."""
    return -(-shares[0] * score // 100), shares[1] * score // 100


def valid_rows(df: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """``id, label, v`` of the rows that take part, with components ``floor(scale * x)``."""
    narrow = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("v"))

    def is_number(x: Column) -> Column:
        d = x.cast("double")
        return x.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))

    taking_part = narrow.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", is_number)
    )

    def scaled(x: Column) -> Column:
        value = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(value) < LIMIT, value).otherwise(F.raise_error(F.lit("a component is beyond the exact range")).cast("long"))

    return taking_part.select("id", "label", F.transform("v", scaled).alias("v"))


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index row per shard from rows that come shard by shard."""

    def finish(shard: int, ids: list[int], labels: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
        values = np.vstack(vectors)
        peak = int(np.abs(values).max(initial=0))
        kept = values.astype(np.int16 if peak < 1 << 15 else np.int32)
        blob = pickle.dumps((np.array(ids), np.array(labels), kept), protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([blob], pa.binary())], ["shard", "lists"])

    shard, ids, labels, vectors = None, [], [], []
    for batch in batches:
        for s, own, label, vector in zip(*(batch.column(i) for i in range(4)), strict=True):
            if shard is not None and s.as_py() != shard:
                yield finish(shard, ids, labels, vectors)
                ids, labels, vectors = [], [], []
            shard = s.as_py()
            ids.append(own.as_py())
            labels.append(label.as_py())
            vectors.append(vector.values.to_numpy(zero_copy_only=False))
    if ids:
        yield finish(shard, ids, labels, vectors)


def _numbered(dim: Column, place: Column) -> Column:
    """Shards are numbered by their vectors' length first."""
    return (dim.cast("long") * (1 << 32) + place).alias("shard")


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """``shard, lists``, one stored row per shard, and ``dim, shards``, the shards of each vector length."""
    stored = materialise(rows.distinct().withColumn("dim", F.size("v")), "negatives-rows")
    sizes = stored.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("long").alias("shards"))
    sizes = materialise(sizes, "negatives-sizes")
    place = F.pmod(F.xxhash64("id", "label", "v"), F.col("shards"))
    dealt = stored.join(sizes, "dim").select(_numbered(F.col("dim"), place), "id", "label", "v")
    met = dealt.repartition("shard").sortWithinPartitions("shard", "id", "label")
    return materialise(met.mapInArrow(_built, "shard bigint, lists binary"), "negatives-index"), sizes


def _in_cells(asked: DataFrame, shards: DataFrame, sizes: DataFrame, blocks: int) -> DataFrame:
    """Rows ``cell, lists`` or ``cell, aid, ...`` by cell, with the lists of a cell's shard first."""
    places = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    anchors = asked.withColumn("dim", F.size("v")).join(sizes, "dim").withColumn("place", places)
    block = F.pmod(F.xxhash64("aid"), F.lit(blocks).cast("long"))
    anchors = anchors.select(
        _numbered(F.col("dim"), F.col("place")), block.alias("block"), "aid", "id", "label", "v", "positives",
        F.lit(None).cast("binary").alias("lists"),
    )
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    held = shards.select("shard", copies.alias("block"), "lists")
    met = held.unionByName(anchors, allowMissingColumns=True).repartition("shard", "block")
    ordered = met.sortWithinPartitions("shard", "block", F.col("aid").asc_nulls_first())
    return ordered.select("lists", "aid", "id", "label", "v", "positives")


def _searching(negatives: int | None, k: int, shares: tuple[int, int]):
    """Positives of each anchor, or with ``negatives`` the rows of its windows, from every cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base: Lists | None = None
        plain = typed = None
        by_label: dict[int, Lists] = {}
        for batch in batches:
            out: tuple[list[int], list[int], list[int], list[int]] = ([], [], [], [])
            for i in range(batch.num_rows):
                blob = batch.column(0)[i]
                if blob.is_valid:
                    plain = build(*pickle.loads(blob.as_py()))
                    peak = int(np.abs(plain.values.astype(np.int64)).max(initial=0))
                    typed, by_label, base = None, {}, None
                    continue
                aid, own, label = (batch.column(j)[i].as_py() for j in (1, 2, 3))
                anchor = batch.column(4)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                kind = exact_type(len(anchor), int(np.abs(anchor).max(initial=0)), peak)
                if kind is not typed:
                    base, typed, by_label = plain._replace(values=plain.values.astype(kind)), kind, {}
                if negatives is None:
                    if label not in by_label:
                        by_label[label] = of_label(base, label)
                    lists = by_label[label]
                    everything = [(float("-inf"), float("inf"))]
                    found = zip([None], first_rows(lists, anchor, lists.ids != own, everything, k), strict=True)
                else:
                    scores = sorted({p["score"] for p in batch.column(5)[i].as_py()})
                    windows = [window_of(s, shares) for s in scores]
                    found = zip(scores, first_rows(base, anchor, base.labels != label, windows, negatives), strict=True)
                for positive_score, rows in found:
                    for row, score in rows:
                        for column, value in zip(out, (aid, positive_score, row, score), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in out], ["aid", "positive_score", "found", "score"]
            )

    return run


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shares: tuple[int, int] = WINDOW,
    shard_rows: int = SHARD_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` and ``anchors`` are ``id, label, v``; anchors are usually some of the rows.
    """
    shards, sizes = index(rows, shard_rows)
    asked = materialise(anchors.distinct().withColumn("aid", F.monotonically_increasing_id()), "negatives-anchors")
    blocks = max(1, -(-asked.count() // block_anchors))
    columns = "aid bigint, positive_score bigint, found bigint, score bigint"

    none = F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("positives")
    cells = _in_cells(asked.select("*", none), shards, sizes, blocks)
    near = _first(cells.mapInArrow(_searching(None, positives, shares), columns), positives, "aid")
    # At most ``positives`` entries of an anchor.
    listed = near.groupBy("aid").agg(F.collect_list(F.struct(F.col("found").alias("id"), "score")).alias("positives"))
    chosen = materialise(asked.join(listed, "aid"), "negatives-positives")

    cells = _in_cells(chosen, shards, sizes, blocks)
    apart = _first(cells.mapInArrow(_searching(negatives, 0, shares), columns), negatives, "aid", "positive_score")
    pairs = chosen.select("aid", F.col("id").alias("anchor_id"), F.inline("positives").alias("positive_id", "positive_score"))
    return pairs.join(apart, ["aid", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
