"""Conversation structure repair: cheapest edits by a parallel Viterbi with rank convergence.

*Problem.* A conversation is rows in order of turn. Each row is kept, given another role, or deleted, and rows may be
inserted, so that the roles read as an optional system row and then pairs of user and assistant, or nothing. Four
states (nothing yet, after system, after user, after assistant) and four costs to go describe any rest of a conversation.

*Chunks.* Rows are range-sorted and cut into chunks of at most ``chunk_rows`` rows and ``chunk_chars`` characters, so a
conversation that holds a third of all rows lies on many tasks. Nearly all conversations are one chunk and are
finished where they were cut. The others, and the few that touch an end of a partition, are *open* chunks.

*Passes.* Each open chunk is walked backwards from a speculative vector of costs to go (the last of a
conversation from the true one). In a fix-up pass a chunk is walked again if the vector that the chunk behind it
ended with differs from the one it used by more than a constant; vectors are kept with their least cost taken
off, so equal means that. Passes end when no chunk changes. Costs are then the sum of what was taken off. Walking
forwards goes the same way: a chunk maps each state it may be entered in to the state it is left in, speculative
entries are corrected until they agree, and every chunk traces its own edits, at each step the least letter on
a cheapest path (D, I, K, R; letters fix the next state, so the audit and the repaired rows are unique).

The digest of a repaired conversation is one chain over its bytes by definition. It is computed chunk by chunk in a
stream that holds one chunk; all other work on a conversation is split.

Defined results: a null role or text is one space; null turns come first, and rows of a null conversation are one
conversation; rows of equal turn are taken in the order of the MD5 of role and text, and equal rows are alike; a
repeated row is a duplicate of the first; an empty text is blank; a very long text is one row, never cut; a conversation
without rows is in no result of ``repair`` and has zeros in ``report``; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodmill.llm.text import BREAKS
from moodmill.storage import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
CHUNK_ROWS = 512
CHUNK_CHARS = 1 << 20
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}

#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after a user or an assistant row put in each state.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}

Vector = tuple[int, int, int, int]
#: Costs to go at the end of a conversation, the least taken off, and the edits that are still needed there.
TERMINAL: Vector = (0, 2 * INSERT, INSERT, 0)
LAST_EDITS = ("", "II", "I", "")
SPECULATIVE: Vector = (0, 0, 0, 0)

#: A row's code: its initial's place here, 4 more if truncated, or MUST_GO.
INITIALS = "sua"
OTHER, CUT, MUST_GO = 3, 4, 8


@lru_cache(maxsize=None)
def step(code: int, after: Vector) -> tuple[int, Vector, tuple[tuple[str, int], ...]]:
    """One row backwards: the cost taken off, the vector before the row, and the edits and next state per state.

    There are few codes, and vectors stay within a few insertions of each other, so the table is small.
    """
    extra = TRUNCATED if code & CUT else 0

    def options(state: int) -> list[tuple[int, str, int]]:
        found = [(DELETE + after[state], "D", state)]
        if code != MUST_GO:
            initial, to = code & 3, NEXT[state]
            if (initial == 0 and state == START) or (initial < OTHER and initial == {USER: 1, ASSISTANT: 2}[to]):
                kept = SYSTEM if initial == 0 else to
                found.append((KEEP + extra + after[kept], "K", kept))
            found.append((REROLE + extra + after[to], "R", to))
        return found

    costs = [min(options(state))[0] for state in STATES]
    for _ in range(2):  # an insertion, and one more behind it
        costs = [min(costs[state], INSERT + costs[NEXT[state]]) for state in STATES]
    moves = []
    for start in STATES:
        edits, state = "", start
        while True:
            cost = costs[state]
            best = min((o for o in options(state) if o[0] == cost), key=lambda o: o[1], default=None)
            if best is not None and (best[1] == "D" or INSERT + costs[NEXT[state]] != cost):
                moves.append((edits + best[1], best[2]))
                break
            edits, state = edits + "I", NEXT[state]
    least = min(costs)
    return least, tuple(c - least for c in costs), tuple(moves)


def walk_back(codes: bytes, right: Vector) -> tuple[int, Vector]:
    """The cost taken off and the vector at the left end of a chunk, from the one at its right end."""
    total, vector = 0, right
    for code in reversed(codes):
        cost, vector, _ = step(code, vector)
        total += cost
    return total, vector


def moves_of(codes: bytes, right: Vector) -> list[tuple[tuple[str, int], ...]]:
    """For each row of a chunk: the least edits and the next state, per state."""
    moves, vector = [], right
    for code in reversed(codes):
        _, vector, move = step(code, vector)
        moves.append(move)
    return moves[::-1]


def exits(codes: bytes, right: Vector) -> list[int]:
    """The state in which a chunk is left, for each in which it may be entered."""
    states = list(STATES)
    for move in moves_of(codes, right):
        states = [move[s][1] for s in states]
    return states


def fault(role: str, text: str, seen: bool) -> int:
    """0 none, 1 blank, 2 duplicate, 3 truncated: the first that holds."""
    bare = text.rstrip(BREAKS)
    if not bare:
        return 1
    return 2 if seen else 0 if bare[-1] in ENDS else 3


def code_of(role: str, fault_: int) -> int:
    if fault_ in (1, 2):
        return MUST_GO
    place = INITIALS.find(role[:1]) if role else -1
    return (place if place >= 0 else OTHER) + (CUT if fault_ == 3 else 0)


def faults_of(roles: list[str], texts: list[str], digests: list[str], repeated: set[int]) -> list[int]:
    """Faults of a chunk's rows; ``repeated`` are the places whose row an earlier chunk already has."""
    seen: set[str] = set()
    found = []
    for place, (role, text, digest) in enumerate(zip(roles, texts, digests, strict=True)):
        found.append(fault(role, text, digest in seen or place in repeated))
        seen.add(digest)
    return found


def trace(
    codes: bytes, roles: list[str], texts: list[str], right: Vector, entry: int, last: bool
) -> tuple[str, list[str], list[str], int]:
    """The audit of a chunk, its repaired roles and texts, and the state after it."""
    audit: list[str] = []
    new_roles: list[str] = []
    new_texts: list[str] = []
    state = entry

    def insert() -> None:
        nonlocal state
        state = NEXT[state]
        new_roles.append(ROLE_OF[state])
        new_texts.append("")

    for place, move in enumerate(moves_of(codes, right)):
        edits, after = move[state]
        audit.append(edits)
        for _ in edits[:-1]:
            insert()
        state = after
        if edits[-1] != "D":
            new_roles.append(roles[place] if edits[-1] == "K" else ROLE_OF[state])
            new_texts.append(texts[place])
    if last:
        audit.append(LAST_EDITS[state])
        for _ in LAST_EDITS[state]:
            insert()
    return "".join(audit), new_roles, new_texts, state


# -- chunks ------------------------------------------------------------------------------


def _cutting(chunk_rows: int, chunk_chars: int, conv: pa.DataType):
    """Chunks of sorted rows; ``open`` ones may have neighbours of the same conversation."""
    schema = pa.schema(
        [("conv", conv), ("part", pa.int32()), ("seq", pa.int64()), ("open", pa.bool_()), ("turns", pa.list_(pa.int64())),
         *((name, pa.list_(pa.string())) for name in ("roles", "texts", "digests"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        conv, chars, continues, seq = None, 0, False, 0
        rows: list[tuple[list, list, list, list]] = [([], [], [], [])]

        def close(is_open: bool) -> None:
            nonlocal chars, seq
            held.append((conv, part, seq, is_open or continues or seq == 0, *rows[0]))
            rows[0], chars, seq = ([], [], [], []), 0, seq + 1

        def flush() -> pa.RecordBatch:
            columns = zip(*held) if held else [()] * len(schema)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            held.clear()
            return made

        for batch in batches:
            for c, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if rows[0][0]:
                    if c != conv:
                        close(False)
                        continues = False
                    elif len(rows[0][0]) >= chunk_rows or chars >= chunk_chars:
                        close(True)
                        continues = True
                conv = c
                for values, value in zip(rows[0], row, strict=True):
                    values.append(value)
                chars += len(row[2])
            yield flush()
        if rows[0][0]:
            close(True)
            yield flush()

    return run


def cut(
    turns: DataFrame, conv: str, turn: str, role: str, text: str, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """The stored chunks ``conv, idx, open, turns, roles, texts, digests``, numbered in order."""
    kind = turns.schema[conv].dataType
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
    )
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.lit(":"), "text"))
    # Equal rows may lie on both sides of a border.
    keyed = rows.select("*", digest.alias("digest"), F.monotonically_increasing_id().alias("copy"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("copy")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy")
    lists = "turns array<bigint>, roles array<string>, texts array<string>, digests array<string>"
    run = _cutting(chunk_rows, chunk_chars, pa_type(kind.simpleString()))
    schema = f"conv {kind.simpleString()}, part int, seq bigint, open boolean, {lists}"
    chunks = materialise(ordered.mapInArrow(run, schema), "turn-chunks")
    sizes = chunks.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the range sort.
    offsets = F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    return chunks.join(offsets, "part").withColumn("idx", F.col("before") + F.col("seq")).drop("part", "seq", "before")


def pa_type(kind: str) -> pa.DataType:
    known = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}
    if kind not in known:
        raise ValueError(f"a conversation key of type {kind} is not supported")
    return known[kind]


# -- open chunks: passes until neighbours agree -----------------------------------------------


def _repeated_places(chunks: DataFrame) -> DataFrame:
    """``idx, repeated``: places of open chunks whose row occurs in an earlier chunk of the conversation."""
    rows = chunks.select("conv", "idx", F.posexplode("digests").alias("place", "digest"))
    first = materialise(rows.groupBy("conv", "digest").agg(F.min("idx").alias("first")), "turn-firsts")
    met = rows.alias("r").join(
        first.alias("f"), F.col("r.conv").eqNullSafe(F.col("f.conv")) & (F.col("r.digest") == F.col("f.digest"))
    )
    later = met.filter("first < idx").select("idx", "place")
    # At most the rows of a chunk.
    return later.groupBy("idx").agg(F.collect_list("place").alias("repeated"))


def _linked(chunks: DataFrame) -> DataFrame:
    """``idx, first, last``: whether a chunk is the first and the last of its conversation."""
    ends = chunks.select("idx", "conv")

    def beside(by: int, name: str) -> DataFrame:
        return ends.select((F.col("idx") + by).alias("idx"), F.struct("conv").alias(name))

    met = ends.join(beside(1, "before"), "idx", "left").join(beside(-1, "behind"), "idx", "left")

    def differs(name: str) -> Column:
        return F.col(name).isNull() | ~F.col(f"{name}.conv").eqNullSafe(F.col("conv"))

    return met.select("idx", differs("before").alias("first"), differs("behind").alias("last"))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = []
        for roles, texts, digests, repeated in zip(*(c.to_pylist() for c in batch.columns[3:]), strict=True):
            found = faults_of(roles, texts, digests, set(repeated or ()))
            codes.append(bytes(map(code_of, roles, found)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary())], ["idx", "first", "last", "codes"])


_PASS = "idx bigint, first boolean, last boolean, codes binary, right array<int>, left array<int>, cost bigint"


def _walking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk a chunk from its right vector, if it has no left one yet."""
    for batch in batches:
        names = batch.schema.names
        columns = {name: batch.column(name).to_pylist() for name in names}
        for i, left in enumerate(columns["left"]):
            if left is None:
                columns["cost"][i], columns["left"][i] = walk_back(columns["codes"][i], tuple(columns["right"][i]))
        types = {"left": pa.list_(pa.int32()), "right": pa.list_(pa.int32()), "cost": pa.int64()}
        arrays = [pa.array(columns[n], types[n]) if n in types else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _vector(values: Vector) -> Column:
    return F.array(*[F.lit(v) for v in values])


def backward(coded: DataFrame) -> tuple[DataFrame, int]:
    """Chunks with the vectors at both ends, which agree with their neighbours', and the number of fix-up passes."""
    guess = F.when(F.col("last"), _vector(TERMINAL)).otherwise(_vector(SPECULATIVE))
    fresh = coded.select(
        "*", guess.alias("right"), F.lit(None).cast("array<int>").alias("left"), F.lit(None).cast("long").alias("cost")
    )
    walked = materialise(fresh.mapInArrow(_walking, _PASS), "turn-costs")
    passes = 0
    while True:
        behind = walked.select((F.col("idx") - 1).alias("idx"), F.col("left").alias("given"))
        met = walked.join(behind, "idx", "left")
        stale = ~F.col("last") & (F.col("given") != F.col("right"))
        if met.filter(stale).isEmpty():
            return walked, passes
        passes += 1
        again = met.select(
            "idx", "first", "last", "codes",
            F.when(stale, F.col("given")).otherwise(F.col("right")).alias("right"),
            F.when(~stale, F.col("left")).alias("left"),
            F.when(~stale, F.col("cost")).alias("cost"),
        )
        walked = materialise(again.mapInArrow(_walking, _PASS), "turn-costs")


def _exiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes, right = batch.column("codes").to_pylist(), batch.column("right").to_pylist()
        found = pa.array([exits(c, tuple(r)) for c, r in zip(codes, right, strict=True)], pa.list_(pa.int32()))
        kept = ["idx", "first", "last", "right", "left", "cost"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), found], [*kept, "exits"])


def forward(walked: DataFrame) -> tuple[DataFrame, int]:
    """The same chunks with ``entry``, the state in which each is entered, and the number of fix-up passes."""
    schema = "idx bigint, first boolean, last boolean, right array<int>, left array<int>, cost bigint, exits array<int>"
    left = walked.mapInArrow(_exiting, schema)
    entry = F.when(F.col("first"), F.lit(START)).otherwise(F.lit(ASSISTANT))
    placed = materialise(left.withColumn("entry", entry), "turn-states")
    passes = 0
    while True:
        before = placed.select((F.col("idx") + 1).alias("idx"), F.get("exits", F.col("entry")).alias("given"))
        met = placed.join(before, "idx", "left")
        stale = ~F.col("first") & (F.col("given") != F.col("entry"))
        if met.filter(stale).isEmpty():
            return placed, passes
        passes += 1
        placed = materialise(
            met.withColumn("entry", F.when(stale, F.col("given")).otherwise(F.col("entry"))).drop("given"), "turn-states"
        )


# -- repair ------------------------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "cost")


def _tracing(conv: pa.DataType):
    """One piece per chunk: counts, costs, audit and repaired rows."""
    schema = pa.schema(
        [("conv", conv), ("idx", pa.int64()), *((name, pa.int64()) for name in _COUNTS),
         ("least_turn", pa.int64()), ("last_turn", pa.int64()), ("heads", pa.list_(pa.string())), ("audit", pa.string()),
         ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for row in batch.to_pylist():
                roles, texts = row["roles"], row["texts"]
                found = faults_of(roles, texts, row["digests"], set(row["repeated"] or ()))
                codes = bytes(map(code_of, roles, found))
                right = tuple(row["right"])
                cost, vector = walk_back(codes, right)
                if row["first"]:
                    cost += vector[START]
                audit, new_roles, new_texts, _ = trace(codes, roles, texts, right, row["entry"], row["last"])
                initials = [r[:1] for r in roles]
                illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                turns = [t for t in row["turns"] if t is not None]
                pieces.append(
                    (row["conv"], row["idx"], found.count(1), found.count(2), found.count(3), illegal, len(set(turns)), cost,
                     turns[0] if turns else None, turns[-1] if turns else None, [initials[0], initials[-1]], audit,
                     new_roles, new_texts)
                )
            columns = zip(*pieces) if pieces else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _piece_schema(kind: str) -> str:
    counts = ", ".join(f"{name} bigint" for name in _COUNTS)
    rest = "least_turn bigint, last_turn bigint, heads array<string>, audit string, roles array<string>, texts array<string>"
    return f"conv {kind}, idx bigint, {counts}, {rest}"


def repair(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces of repaired conversations, in order of ``idx``: those that are whole, and those of open chunks.

    A piece has the repaired ``roles`` and ``texts``, the ``audit`` of its edits, and the counts of its rows.
    """
    kind = chunks.schema["conv"].dataType.simpleString()
    run = _tracing(pa_type(kind))
    wanted = ["conv", "idx", "turns", "roles", "texts", "digests", "repeated", "first", "last", "right", "entry"]

    whole = chunks.filter(~F.col("open")).select(
        "*", F.lit(None).cast("array<int>").alias("repeated"), F.lit(True).alias("first"), F.lit(True).alias("last"),
        _vector(TERMINAL).alias("right"), F.lit(START).alias("entry"),
    )
    open_chunks = materialise(chunks.filter("open"), "turn-open")
    repeated = materialise(_repeated_places(open_chunks), "turn-repeats")
    marked = open_chunks.join(repeated, "idx", "left")
    linked = marked.join(_linked(open_chunks), "idx")
    coded = linked.select("idx", "first", "last", "roles", "texts", "digests", "repeated").mapInArrow(
        _coded, "idx bigint, first boolean, last boolean, codes binary"
    )
    placed, _ = forward(backward(coded)[0])
    ready = marked.join(placed.select("idx", "first", "last", "right", "entry"), "idx")
    schema = _piece_schema(kind)
    return whole.select(*wanted).mapInArrow(run, schema), ready.select(*wanted).mapInArrow(run, schema)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``conv, idx, place, role, text``: the repaired rows, in order of ``idx`` and ``place``."""
    return pieces.select("conv", "idx", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")).select(
        "conv", "idx", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text")
    )


_FOUND = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _joining(conv: pa.DataType):
    """Conversations from pieces that come in order; one piece is held, and the letters of the audit."""
    numbers = [(name, pa.int64()) for name in _FOUND[:-2]]
    schema = pa.schema([("conv", conv), *numbers, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current: dict | None = None

        def finish() -> None:
            c = current
            gaps = c["last_turn"] - c["least_turn"] + 1 - c["turns"] if c["turns"] else 0
            done.append(
                (c["conv"], gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], c["cost"],
                 "".join(c["audit"]), c["sha"].hexdigest())
            )

        for batch in batches:
            for i in range(batch.num_rows):
                piece = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if current is None or piece["conv"] != current["conv"]:
                    if current is not None:
                        finish()
                    current = {**piece, "audit": [], "sha": hashlib.sha256(), "begun": False}
                else:
                    for name in _COUNTS:
                        current[name] += piece[name]
                    current["illegal"] += current["heads"][1] + piece["heads"][0] not in LEGAL
                    if piece["least_turn"] is not None:
                        if current["last_turn"] == piece["least_turn"]:
                            current["turns"] -= 1
                        if current["least_turn"] is None:
                            current["least_turn"] = piece["least_turn"]
                        current["last_turn"] = piece["last_turn"]
                    current["heads"] = piece["heads"]
                current["audit"].append(piece["audit"])
                for role, text in zip(piece["roles"], piece["texts"], strict=True):
                    current["sha"].update(("\n" if current["begun"] else "").encode() + f"{role}:{text}".encode())
                    current["begun"] = True
            columns = zip(*done) if done else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            done.clear()
        if current is not None:
            finish()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done), schema, strict=True)], schema=schema
            )

    return run


def report(
    conversations: DataFrame, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row for every ``conv`` of ``conversations``: faults, cost, audit and digest of its repaired ``turns``."""
    kind = turns.schema[conv].dataType.simpleString()
    whole, parts = repair(cut(turns, conv, turn, role, text, chunk_rows, chunk_chars))
    gaps = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("least_turn") + 1 - F.col("turns")).otherwise(F.lit(0))
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    alone = whole.select(
        "conv", gaps.cast("long").alias("gaps"), *_FOUND[1:-1], F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )
    found = ", ".join(f"{name} bigint" for name in _FOUND[:-2])
    joined = (
        parts.repartition("conv")
        .sortWithinPartitions("conv", "idx")
        .mapInArrow(_joining(pa_type(kind)), f"conv {kind}, {found}, audit string, repaired_sha256 string")
    )
    results = alone.unionByName(joined).withColumnRenamed("conv", "_conv")
    known = conversations.select(conv).distinct()
    met = known.join(results, F.col(conv).eqNullSafe(F.col("_conv")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return met.select(
        conv,
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in _FOUND[:-2]),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows dropped, emptied, stripped of their ends, repeated or given to the user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = (F.crc32(key.cast("binary")) % 20).alias("hit")
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), hit
    )
    bare = F.regexp_replace("text", "[.!?]", "")
    return rows.filter("hit <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, bare).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
