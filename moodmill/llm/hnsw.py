"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged.

*Vectors.* Equal vectors are one node that remembers its ``k + 1`` smallest ids; no further one can
be among the nearest ``k`` of any query, so every row is indexed and a vector that a third of all
rows hold is one node. Nodes are dealt to shards by a hash. Every query visits every shard, and a larger shard costs it
only a little more, so shards grow with the table, up to ``MOST_ROWS`` nodes; each length of
vector has shards of its own, for vectors of different lengths have no distance.

*Graphs.* A shard's graph is built by inserting nodes in turn: a greedy walk through the upper layers,
a beam search in the lower ones, and links to neighbours that are not nearer to each other than to
the node. Neighbours of all nodes of a layer lie in one flat array. The index is a table of one row
per shard, so a lost executor rebuilds or rereads single shards.

*Search.* Every query visits every shard of its length. A shard reads its queries as a stream, keeps
none of them, and returns the nearest ``k`` rows with exact double-precision distances; a window
merges the shards. There is no product of queries and rows.

Defined results: vectors that are null, empty, all zero, or hold null or non-finite components are
neither indexed nor queried, nor are rows without an id; rows equal in id and vector are one
candidate; an empty table gives an empty table. Ties go to the smaller id. Other columns, whatever their names, are
not read; there are no texts.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.storage import materialise

K = 10
#: Nodes of a shard, on average: the shards are as many as the root of nodes by LEAST_ROWS, and none has
#: more than MOST_ROWS, for which the beam finds 0.95 or more of the neighbours.
LEAST_ROWS = 4096
MOST_ROWS = 16_384
#: Links of a node in an upper layer; twice as many in the lowest.
LINKS = 16
BUILD_BEAM = 96
SEARCH_BEAM = 128


class Graph(NamedTuple):
    vectors: np.ndarray
    #: Per layer: the node behind each slot, the slot of each node, and flat neighbours, -1 where none.
    members: list[np.ndarray]
    slots: list[np.ndarray]
    neighbours: list[np.ndarray]
    entry: int


def _distances(vectors: np.ndarray, at: np.ndarray | list[int], query: np.ndarray) -> np.ndarray:
    apart = vectors[at] - query
    return np.einsum("ij,ij->i", apart, apart)


def _walk(graph: Graph, layer: int, query: np.ndarray, node: int) -> int:
    """The node where going to the nearest neighbour ends."""
    width = len(graph.neighbours[layer]) // max(len(graph.members[layer]), 1)
    best = float(_distances(graph.vectors, [node], query)[0])
    while True:
        slot = graph.slots[layer][node]
        near = graph.neighbours[layer][slot * width : (slot + 1) * width]
        near = near[near >= 0]
        if not len(near):
            return node
        far = _distances(graph.vectors, near, query)
        i = int(far.argmin())
        if far[i] >= best:
            return node
        node, best = int(near[i]), float(far[i])


def _beam(graph: Graph, layer: int, query: np.ndarray, entry: int, size: int, seen: np.ndarray, mark: int) -> list[tuple[float, int]]:
    """The nearest ``size`` nodes that a beam search finds, nearest first."""
    flat, slots = graph.neighbours[layer], graph.slots[layer]
    width = len(flat) // len(graph.members[layer])
    start = float(_distances(graph.vectors, [entry], query)[0])
    seen[entry] = mark
    open_, found = [(start, entry)], [(-start, entry)]
    while open_:
        distance, node = heapq.heappop(open_)
        if len(found) >= size and distance > -found[0][0]:
            break
        slot = slots[node]
        near = flat[slot * width : (slot + 1) * width]
        near = near[near >= 0]
        near = near[seen[near] != mark]
        if not len(near):
            continue
        seen[near] = mark
        far = _distances(graph.vectors, near, query)
        if len(found) >= size:
            inside = far < -found[0][0]
            near, far = near[inside], far[inside]
        for d, v in zip(far.tolist(), near.tolist(), strict=True):
            if len(found) < size:
                heapq.heappush(open_, (d, v))
                heapq.heappush(found, (-d, v))
            elif d < -found[0][0]:
                heapq.heappush(open_, (d, v))
                heapq.heapreplace(found, (-d, v))
    return sorted((-d, v) for d, v in found)


def _chosen(vectors: np.ndarray, candidates: list[tuple[float, int]], most: int) -> list[int]:
    """Nearest candidates that are nearer to the node than to each other; filled up with the rest."""
    if len(candidates) <= most:
        return [v for _, v in candidates]
    nodes = np.array([v for _, v in candidates])
    points = vectors[nodes]
    squares = np.einsum("ij,ij->i", points, points)
    apart = squares[:, None] + squares[None, :] - 2.0 * (points @ points.T)
    to_node = np.array([d for d, _ in candidates])
    blocked = np.zeros(len(nodes), dtype=bool)
    kept: list[int] = []
    for i in range(len(nodes)):
        if not blocked[i]:
            kept.append(i)
            if len(kept) == most:
                break
            blocked |= apart[i] < to_node
    if len(kept) < most:
        have = set(kept)
        kept += [i for i in range(len(nodes)) if i not in have][: most - len(kept)]
    return nodes[kept].tolist()


def build(vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 7) -> Graph:
    """The graph over the rows of ``vectors``; the same rows give the same graph."""
    n = len(vectors)
    levels = (-np.log(1.0 - np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
    top = int(levels.max(initial=0))
    members = [np.flatnonzero(levels >= layer) for layer in range(top + 1)]
    slots, neighbours, widths = [], [], []
    for layer, own in enumerate(members):
        slot = np.full(n, -1, dtype=np.int64)
        slot[own] = np.arange(len(own))
        widths.append(2 * links if layer == 0 else links)
        slots.append(slot)
        neighbours.append(np.full(len(own) * widths[-1], -1, dtype=np.int32))
    counts = [np.zeros(len(own), dtype=np.int64) for own in members]
    seen = np.zeros(n, dtype=np.int64)
    graph = Graph(vectors, members, slots, neighbours, 0)
    entry, reached, mark = 0, int(levels[0]) if n else 0, 0
    for node in range(1, n):
        query, level, at = vectors[node], int(levels[node]), entry
        for layer in range(reached, level, -1):
            at = _walk(graph, layer, query, at)
        for layer in range(min(level, reached), -1, -1):
            mark += 1
            found = _beam(graph, layer, query, at, beam, seen, mark)
            at = found[0][1]
            width, flat, slot, count = widths[layer], neighbours[layer], slots[layer], counts[layer]
            near = _chosen(vectors, found, links)
            own = int(slot[node])
            flat[own * width : own * width + len(near)] = near
            count[own] = len(near)
            for other in near:
                place = int(slot[other])
                if count[place] < width:
                    flat[place * width + count[place]] = node
                    count[place] += 1
                else:
                    held = np.append(flat[place * width : (place + 1) * width], node)
                    far = _distances(vectors, held, vectors[other])
                    order = np.argsort(far, kind="stable")
                    pruned = _chosen(vectors, list(zip(far[order].tolist(), held[order].tolist(), strict=True)), width)
                    flat[place * width : place * width + len(pruned)] = pruned
                    flat[place * width + len(pruned) : (place + 1) * width] = -1
                    count[place] = len(pruned)
        if level > reached:
            entry, reached = node, level
    return graph._replace(entry=entry)


def search(graph: Graph, query: np.ndarray, size: int, seen: np.ndarray, mark: int) -> list[tuple[float, int]]:
    """About the nearest ``size`` nodes, nearest first; ``seen`` and ``mark`` tell visits apart."""
    node = graph.entry
    for layer in range(len(graph.members) - 1, 0, -1):
        node = _walk(graph, layer, query, node)
    return _beam(graph, 0, query, node, size, seen, mark)


def valid_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the rows that take part."""
    doubles = F.col(vector).cast("array<double>")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        table.select(F.col(key).alias("id"), doubles.alias("v"))
        .filter("id is not null and v is not null and size(v) > 0")
        .filter(~odd)
        .filter(F.exists("v", lambda x: x != 0.0))
    )


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index row per shard from rows that come shard by shard."""

    def finish(shard: int, nodes: list[np.ndarray], ids: list[list[int]]) -> pa.RecordBatch:
        graph = build(np.vstack(nodes))
        blob = pickle.dumps((graph, ids), protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([blob], pa.binary())], ["shard", "graph"])

    shard, nodes, ids = None, [], []
    for batch in batches:
        for s, vector, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            if shard is not None and s != shard:
                yield finish(shard, nodes, ids)
                nodes, ids = [], []
            shard = s
            nodes.append(vector.values.to_numpy(zero_copy_only=False))
            ids.append(own)
    if nodes:
        yield finish(shard, nodes, ids)


def shard_count(nodes: Column) -> Column:
    by_root = F.sqrt(nodes / LEAST_ROWS)
    return F.ceil(F.greatest(by_root, nodes / MOST_ROWS)).cast("long")


def index(rows: DataFrame, k: int = K, shard_rows: int | None = None) -> DataFrame:
    """``shard, dim, graph``: the stored index of all ``id, v`` rows, in shards of ``shard_rows`` nodes if given."""
    small = Window.partitionBy("v").orderBy("id")
    nodes = (
        rows.distinct()
        .withColumn("place", F.row_number().over(small))
        .filter(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("dim", F.size("v"))
    )
    stored = materialise(nodes, "ann-nodes")
    n = F.col("count")
    shards = F.ceil(n / shard_rows).cast("long") if shard_rows else shard_count(n)
    sizes = stored.groupBy("dim").count().select("dim", shards.alias("shards"))
    # Shards are numbered by their vectors' length first.
    dealt = stored.join(F.broadcast(sizes), "dim").select(
        (F.col("dim").cast("long") * (1 << 32) + F.pmod(F.xxhash64("v"), F.col("shards"))).alias("shard"), "v", "ids"
    )
    # In order of id, so that the same rows always give the same graph.
    met = dealt.repartition("shard").sortWithinPartitions("shard", F.col("ids")[0])
    built = met.mapInArrow(_built, "shard bigint, graph binary")
    return materialise(built, "ann-index")


def nearest(queries: DataFrame, shards: DataFrame, k: int = K, beam: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``k`` other rows of each ``id, v`` query."""
    dim = F.shiftright("shard", 32).cast("int").alias("dim")
    # One small row per length of vector.
    places = shards.groupBy(dim).agg(F.collect_list("shard").alias("shards"))
    asked = (
        queries.distinct()
        .withColumn("dim", F.size("v"))
        .join(F.broadcast(places), "dim")
        .select(F.explode("shards").alias("shard"), F.col("id"), "v", F.lit(None).cast("binary").alias("graph"))
    )
    held = shards.select("shard", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("array<double>").alias("v"), "graph")
    # The graph of a shard comes first, then its queries one by one.
    met = held.unionByName(asked).repartition("shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = ids = seen = None
        mark = 0
        for batch in batches:
            out: tuple[list[int], list[int], list[float]] = ([], [], [])
            for blob, query, vector in zip(batch.column(3), batch.column(1), batch.column(2), strict=True):
                if blob.is_valid:
                    graph, ids = pickle.loads(blob.as_py())
                    seen, mark = np.zeros(len(ids), dtype=np.int64), 0
                    continue
                mark += 1
                own = query.as_py()
                point = vector.values.to_numpy(zero_copy_only=False)
                found = search(graph, point, max(beam, k + 1), seen, mark)
                rows = [(d, i) for d, node in found for i in ids[node] if i != own]
                rows.sort()
                for d, i in rows[:k]:
                    out[0].append(own)
                    out[1].append(i)
                    out[2].append(float(np.sqrt(d)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                ["query_id", "vec_id", "score"],
            )

    found = met.select("shard", "id", "v", "graph").mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
