"""Conversation repair against brute force over whole edit sequences, and chunks against one walk."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from moodmill.llm import conversation_repair as cr
from tools.compare import compare, connect

sys.setrecursionlimit(20_000)

SCHEMA = "conv_id long, turn long, role string, text string, conv string, idx string, texts string, open string, part string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def in_order(rows):
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))


def cheapest(rows):
    """The least (cost, audit) and the repaired rows, over all edits, from the definition."""
    seen, forced, extra = set(), [], []
    counts = [0, 0, 0]
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            counts[kind] += 1
        forced.append(kind in (0, 1))
        extra.append(5 if kind == 2 else 0)

    @lru_cache(maxsize=None)
    def best(at, state, inserts):
        options = []
        if at == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            def add(cost, letter, after, lines):
                c, a, ls = best(at + 1, after, 0)
                options.append((cost + c, letter + a, lines + ls))

            add(2, "D", state, ())
            if not forced[at]:
                role, text = rows[at][2:]
                initial = role[:1]
                to = "a" if state == "u" else "u"
                if (initial == "s" and state == "") or initial == to:
                    add(extra[at], "K", initial, (f"{role}:{text}",))
                add(1 + extra[at], "R", to, (f"{'user' if to == 'u' else 'assistant'}:{text}",))
        if inserts < 3:
            to = "a" if state == "u" else "u"
            c, a, ls = best(at, to, inserts + 1)
            options.append((5 + c, "I" + a, (f"{'user' if to == 'u' else 'assistant'}:",) + ls))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    return counts, cost, audit, lines


def brute(rows, damaged_rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = in_order([r for r in damaged_rows if r[0] == conv])
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts, cost, audit, lines = cheapest(own) if own else ([0, 0, 0], 0, "", ())
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def reported(spark, rows, turns=None, **options):
    make = lambda rows: spark.createDataFrame([(*r, *("clash",) * 5) for r in rows], SCHEMA)
    conversations = make(rows)
    turns = cr.damaged(conversations) if turns is None else make(turns)
    return sorted((tuple(r) for r in cr.report(conversations, turns, **options).collect()), key=str)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["yes.", "yes", "", " \t", "well!", "no?", "a. b", "x. \n", "long " * 20 + ".", "é…", "e."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "u", None]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."
            number = None if rng.random() < 0.05 else turn + rng.randrange(2) * rng.randrange(3)
            rows.append((conv, number, rng.choice(roles), text if rng.random() < 0.97 else None))
    return rows


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 3, "chunk_chars": 60}])
def test_equals_brute_force(spark, options):
    rows = random_rows(1, 60, 25)
    rows += [(None, None, None, None), (None, 3, "user", "hi."), (None, 3, "user", "hi."), (500, 7, "user", None)]
    rows += rows[:20]
    assert reported(spark, rows, **options) == brute(rows, damage(rows))


def test_a_hot_conversation_over_many_chunks(spark):
    rng = random.Random(7)
    roles = ["user", "assistant"]
    hot = [(1, t, roles[t % 2] if rng.random() < 0.7 else rng.choice(roles), rng.choice(["ok.", f"{t}.", f"{t}"])) for t in range(500)]
    rows = hot + [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in random_rows(8, 30, 6)]
    assert reported(spark, rows, turns=rows, chunk_rows=7) == brute(rows, rows)


def test_passes_until_vectors_agree(spark):
    """Speculative starts are wrong here: only a whole walk knows in which state the repeated rows are met."""
    for seed in range(2):
        rng = random.Random(seed)
        codes = [bytes(rng.choice([0, 1, 2, 3, 5, 6, 8]) for _ in range(6)) for _ in range(40)]
        whole = b"".join(codes)
        rows = [(i, i == 0, i == 39, bytearray(c)) for i, c in enumerate(codes)]
        coded = spark.createDataFrame(rows, "idx long, first boolean, last boolean, codes binary")
        walked, passes = cr.backward(coded)
        placed, again = cr.forward(walked)
        got = {r.idx: r for r in placed.collect()}
        cost, vector = cr.walk_back(whole, cr.TERMINAL)
        assert sum(r["cost"] for r in got.values()) == cost and tuple(got[0].left) == vector
        state = cr.START
        for i, c in enumerate(codes):
            right = cr.walk_back(b"".join(codes[i + 1 :]), cr.TERMINAL)[1]
            assert (tuple(got[i].right), got[i].entry) == (right, state)
            state = cr.exits(c, right)[state]
        assert passes >= 1


def test_repaired_rows_read_as_the_grammar(spark):
    rows = random_rows(9, 80, 12)
    df = spark.createDataFrame([r for r in rows], "conv_id long, turn long, role string, text string")
    for pieces in cr.repair(cr.cut(df, "conv_id", "turn", "role", "text")):
        turns = {}
        for r in cr.repaired_turns(pieces).orderBy("conv", "idx", "place").collect():
            turns.setdefault(r.conv, []).append(r.role[:1])
        assert all(re.fullmatch("(s?(ua)+)?", "".join(t)) for t in turns.values())


def test_very_long_text_and_no_rows(spark):
    long = "word " * 400_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "user", long), (2, 0, "user", "gone.")]
    turns = rows[:3]
    assert reported(spark, rows, turns=turns) == brute(rows, turns)
    assert reported(spark, []) == []


def test_query_matches_sql(spark, small):
    verdict, _, _ = compare(connect(small), spark, small, "op13_conversation_repair")
    assert verdict.startswith("ok"), verdict
