"""SimHash near-duplicates: 64-bit fingerprints joined with themselves by binary tries.

*Fingerprints.* A text's words (ASCII letters lower-cased) form shingles; a bit is 1 if more than
half of the shingles' XXH64 values (seed 42) have it set.

*Self-join.* Equal fingerprints are one entry. 64 bits are cut into ``budget + agree`` blocks; two fingerprints
within the budget agree in at least ``agree`` of them, so entries meet in the groups of (blocks, their value). One
block is enough for few entries; the more there are, the more blocks have to agree, so that groups stay
small: the value has 12, 21, 27 or 32 bits at 5, 15, 35 or 70 groups an entry.
Each group builds a binary trie, as ranges of a sorted array, over the remaining bits and walks
pairs of nodes together: a pair of nodes carries the bits in which its prefixes differ and is
dropped beyond the budget, or when both nodes lie in one component already. A task returns a star
per component and never the pairs. A group above ``group_rows`` is cut into chunks that meet two by two.

*Components.* The stars of all tasks are joined to components by minimum labels.

Defined results: a null text, or one without words, has fingerprint zero and links like any other;
fewer words than a shingle form one shingle; repeated rows share everything; a null key never is the
least one, and a component of null keys alone has a null id; a very long text is read whole; an empty table gives an
empty table; other columns, whatever their names, are not read by ``near_duplicates`` and come back unchanged from
``keep_one``. ``keep_one`` keeps the row with the least (key, digest of the text) of each component, null keys last, and one
of rows that are equal in both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.llm.components import components
from moodmill.storage import materialise

SHINGLE = 4
BUDGET = 4
#: Entries of a group on average, above which more blocks have to agree, and the most that have to.
AVERAGE_GROUP = 64
MOST_AGREE = 4
#: Entries of a (block, value) group that one trie takes.
GROUP_ROWS = 4096
#: Rows that a task gathers before it walks their tries together, and node pairs walked at once.
BATCH_ROWS = 1 << 16
FRONTIER = 1 << 18

_BYTE_ONES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are 1 where more than half of the hashes have a 1."""
    steps = np.arange(0, len(hashes), 255)
    ones = np.empty((8, 8), dtype=np.int64)
    for bit in range(8):
        # Eight counters in a word, one per byte, that hold up to 255 each.
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _BYTE_ONES, steps)
        ones[:, bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones.reshape(-1) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(width, len(words))
    begins = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(begins, ends[width - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, dtype=np.uint64))


def fingerprints(docs: DataFrame, keep: str, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp`` (the 64 bits as a long) of every row."""
    narrow = docs.select(F.col(keep).alias("k"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            values = np.fromiter(
                (fingerprint(x.as_py(), width) for x in texts), dtype=np.uint64, count=len(texts)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["k", "fp"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInArrow(run, f"k {kind}, fp bigint").withColumnRenamed("k", keep)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots of all entries after the pairs ``(a, b)`` are united."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = _roots(parent)


def trie_components(values: np.ndarray, groups: np.ndarray, budget: int) -> np.ndarray:
    """Component (as the least place) of every entry among those of its group within the budget.

    A row of ``values`` is a fingerprint of one or more 64-bit words; rows are distinct within a group
    and sorted by (group, words).
    """
    n, words = values.shape
    parent = np.arange(n)
    ones: dict[int, np.ndarray] = {}

    def ones_before(depth: int) -> np.ndarray:
        """Set bits at a depth among the first i entries, for all i; splits nodes without a search."""
        if depth not in ones:
            bit = (values[:, depth // 64] >> np.uint64(63 - depth % 64)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(bit, dtype=np.int32)].astype(np.int32)
        return ones[depth]

    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]).astype(np.int32)
    stops = np.r_[starts[1:], n].astype(np.int32)
    live = stops - starts > 1
    none = np.zeros(int(live.sum()), np.int16)
    stack = [(0, starts[live], stops[live], starts[live], stops[live], none)]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > FRONTIER:
            stack.append((depth, *(x[FRONTIER:] for x in (alo, ahi, blo, bhi, diff))))
            alo, ahi, blo, bhi, diff = (x[:FRONTIER] for x in (alo, ahi, blo, bhi, diff))
        # Nodes whose entries all lie in one component already have nothing left to find.
        changes = np.cumsum(np.r_[0, parent[1:] != parent[:-1]])
        one = (changes[ahi - 1] == changes[alo]) & (changes[bhi - 1] == changes[blo])
        open_ = ~(one & (parent[alo] == parent[blo]))
        alo, ahi, blo, bhi, diff = (x[open_] for x in (alo, ahi, blo, bhi, diff))
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            a, b = alo[single], blo[single]
            apart = np.zeros(len(a), dtype=np.int64)
            for word in range(words):
                apart += np.bitwise_count(values[a, word] ^ values[b, word])
            near = apart <= budget
            parent = _unite(parent, a[near], b[near])
            alo, ahi, blo, bhi, diff = (x[~single] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        set_bits = ones_before(depth)
        amid = ahi - (set_bits[ahi] - set_bits[alo])
        bmid = bhi - (set_bits[bhi] - set_bits[blo])
        same = alo == blo
        parts = (
            (alo, amid, blo, bmid, diff, None),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, ~same),
        )
        kept = []
        for plo, phi, qlo, qhi, errors, also in parts:
            full = (phi > plo) & (qhi > qlo) & (errors <= budget)
            full &= ~((plo == qlo) & (phi - plo == 1))
            if also is not None:
                full &= also
            kept.append([x[full] for x in (plo, phi, qlo, qhi, errors)])
        joined = [np.concatenate(x) for x in zip(*kept, strict=True)]
        if len(joined[0]):
            stack.append((depth + 1, *joined))
    return parent


def must_agree(count: int, budget: int) -> int:
    """How many blocks have to agree so that a group has ``AVERAGE_GROUP`` entries or fewer on average."""
    for agree in range(1, MOST_AGREE):
        if count <= AVERAGE_GROUP << (64 // (budget + agree) * agree):
            return agree
    return MOST_AGREE


def block_orders(budget: int, agree: int) -> list[list[tuple[int, int]]]:
    """For each choice of ``agree`` blocks: ``(shift, bits)`` of all blocks, the chosen ones first."""
    blocks = budget + agree
    sizes = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    bounds = [(sum(sizes[:i]), size) for i, size in enumerate(sizes)]
    chosen = combinations(range(blocks), agree)
    return [[bounds[i] for i in pick] + [bounds[i] for i in range(blocks) if i not in pick] for pick in chosen]


def reordered(fps: np.ndarray, choice: np.ndarray, orders: list[list[tuple[int, int]]]) -> np.ndarray:
    """Fingerprints with their blocks in the order of their choice, so that the walk starts below the shared ones."""
    out = np.zeros(len(fps), dtype=np.uint64)
    for c in np.unique(choice):
        mine = choice == c
        left, given = 64, fps[mine]
        turned = np.zeros(len(given), dtype=np.uint64)
        for shift, size in orders[c]:
            left -= size
            turned |= ((given >> np.uint64(shift)) & np.uint64((1 << size) - 1)) << np.uint64(left)
        out[mine] = turned
    return out


def _met(entries: DataFrame, group_rows: int, node: str) -> DataFrame:
    """Entries gathered by (block, value); a group above ``group_rows`` as pairs of its chunks."""
    large = (
        entries.groupBy("block", "value")
        .count()
        .filter(F.col("count") > group_rows)
        .select("block", "value", F.ceil(F.col("count") * 2 / group_rows).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64(node), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("chunk"))
    pair = F.transform(
        others,
        lambda c: F.least(c, F.col("chunk")).cast("long") * F.col("chunks") + F.greatest(c, F.col("chunk")),
    )
    alone = F.array(F.lit(-1).cast("long"))
    dealt = (
        entries.join(large, ["block", "value"], "left")
        .withColumn("chunk", chunk)
        .withColumn("pair", F.explode(F.when(F.col("chunks").isNull(), alone).otherwise(pair)))
        .drop("chunks", "chunk")
    )
    return dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


_GROUP = ["block", "value", "pair"]


def _stars(
    solve: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], weigh: Callable[[pd.DataFrame], int] = len
):
    """A task body that gives ``solve`` whole groups, several at a time, with the number of each row's group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solved(rows: pd.DataFrame) -> pd.DataFrame:
            keys = rows[_GROUP].to_numpy()
            return solve(rows, np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)]))

        waiting: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            waiting.append(batch)
            held += weigh(batch)
            if held < BATCH_ROWS:
                continue
            rows = pd.concat(waiting, ignore_index=True)
            keys = rows[_GROUP].to_numpy()
            # The last group may go on in the next batch.
            changes = np.flatnonzero((keys != keys[-1]).any(axis=1))
            whole = int(changes[-1]) + 1 if len(changes) else 0
            if whole:
                yield solved(rows.iloc[:whole])
            waiting = [rows.iloc[whole:].reset_index(drop=True)]
            held = weigh(waiting[0])
        if held:
            yield solved(pd.concat(waiting, ignore_index=True))

    return run


def links(distinct: DataFrame, budget: int = BUDGET, group_rows: int = GROUP_ROWS, agree: int | None = None) -> DataFrame:
    """Stars ``(a, b)`` that connect all distinct ``fp`` within the budget of each other.

    ``agree`` decides how entries meet, not what is found; it follows from their number unless given.
    """
    orders = block_orders(budget, must_agree(distinct.count(), budget) if agree is None else agree)
    chosen = len(orders[0]) - budget

    def value(order: list[tuple[int, int]]) -> Column:
        parts, left = F.lit(0).cast("long"), 0
        for shift, size in reversed(order[:chosen]):
            block = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << size) - 1))
            parts, left = parts.bitwiseOR(F.shiftleft(block, left)), left + size
        return parts

    groups = F.array(*(F.struct(F.lit(i).alias("block"), value(o).alias("value")) for i, o in enumerate(orders)))
    met = _met(distinct.select("fp", F.inline(groups)), group_rows, "fp")

    def solve(rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().view(np.uint64)
        turned = reordered(fps, rows["block"].to_numpy(), orders)
        order = np.lexsort((turned, group))
        fps = fps[order].view(np.int64)
        root = trie_components(turned[order][:, None], group[order], budget)
        linked = root != np.arange(len(root))
        return pd.DataFrame({"a": fps[linked], "b": fps[root[linked]]})

    return met.mapInPandas(_stars(solve), "a bigint, b bigint")


def _rooted(distinct: DataFrame, budget: int, group_rows: int) -> DataFrame:
    """``distinct`` rows, unique in ``fp``, with ``root``, which names their component."""
    labels = components(links(distinct.select("fp"), budget, group_rows)).withColumnRenamed("node", "fp")
    return distinct.join(labels, "fp", "left").withColumn("root", F.coalesce("label", "fp")).drop("label")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    budget: int = BUDGET,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the least key reachable) for every row."""
    stored = materialise(fingerprints(docs, key, text, width), "simhash")
    first = materialise(stored.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    rooted = _rooted(first, budget, group_rows)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.join(least, "root").select("fp", "component_id")
    return stored.join(ids, "fp").select(key, "fp", "component_id")


_ROW = ["_null", "_key", "_digest"]


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    budget: int = BUDGET,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row of each component of near-duplicates, with all columns of ``docs``.

    Only keys and digests travel until the rows to keep are known.
    """
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    # Rows in a form of their own, whatever the columns are called.
    bound = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()],
        F.col(f"`{key}`").isNull().alias("_null"),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_digest"),
    )
    row = F.struct("_null", names[key], "_key", "_digest")
    stored = materialise(fingerprints(bound.withColumn("_row", row), "_row", names[text], width), "simhash-rows")
    # The least row of each fingerprint, and of each component; one row per task and fingerprint travels.
    first = materialise(stored.groupBy("fp").agg(F.min("_row").alias("_row")), "simhash-distinct")
    least = _rooted(first, budget, group_rows).groupBy("root").agg(F.min("_row").alias("_row"))
    chosen = least.select(*[F.col(f"_row.{c}").alias(c) for c in _ROW])
    counts = stored.select(*[F.col(f"_row.{c}").alias(c) for c in _ROW]).groupBy(*_ROW).count()
    staying = materialise(chosen.join(counts, _ROW), "simhash-keepers")
    own = [F.col(n).alias(c) for c, n in names.items()]
    single = bound.join(staying.filter("count = 1").select(*_ROW), _ROW, "left_semi").select(*own)
    # Of rows that are equal in key and text, one stays.
    equal = bound.join(staying.filter("count > 1").select(*_ROW), _ROW, "left_semi")
    order = Window.partitionBy(*_ROW).orderBy(F.xxhash64(*names.values()))
    one = equal.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select(*own)
    return single.unionByName(one)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
