"""Token files and packing: exact round trips on whole texts."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moodmill.llm import packing, range_coder, token_file
from moodmill.llm.token_ids import encoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [None, "", " ", "a  b", " x", "x ", "a\n\nb", "a \nb", "don't 'll", "tab\tx\x0by\x85z", "\x1cq\x1d", "é ́ 日本 ½", "a b", "<|endoftext|> a"]


@pytest.mark.parametrize(("path", "keeps_space"), [(BYTES, True), (WORDS, False)])
def test_ids_equal_the_library(small_texts, path, keeps_space):
    texts = [*ODD, *(t["text"] for t in small_texts)]
    library = Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder(path, keeps_space)(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_range_coder_round_trip():
    rng = np.random.default_rng(2)
    blocks = [
        np.zeros(0, np.uint16),
        np.full(3000, 7, np.uint16),
        rng.integers(0, 1 << 16, 2048).astype(np.uint16),
        np.array([65535, 0, 65535], np.uint16),
        *(rng.zipf(1.2, n).clip(0, 50_000).astype(np.uint16) for n in range(1, 400, 37)),
    ]
    coded = range_coder.encode(blocks)
    back = range_coder.decode(coded, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back, strict=True))
    assert len(coded[1]) < 200
    alone = [range_coder.encode([b])[0] for b in blocks]
    assert alone == coded  # blocks do not depend on their neighbours


def expected(rows, path, end):
    library = Tokenizer.from_file(path)
    return [(k, np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for k, t in rows]


def test_token_files(spark, odd, odd_rows, empty, tmp_path):
    path = str(tmp_path / "ids")
    got = token_file.digest(odd, BYTES, path=path).collect()
    want = expected([(r[0], r[1]) for r in odd_rows], BYTES, 0)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (k, len(ids), zlib.crc32(ids.tobytes())) for k, ids in want
    )
    placed = sorted(got, key=lambda r: r.start)
    at = 0
    for r in placed:
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in placed]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert token_file.digest(empty, BYTES).count() == 0


def test_damage_is_found(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words " * 500)], "doc_id long, text string")
    path = tmp_path / "ids"
    token_file.write(df, str(path), BYTES)
    (file,) = [f for f in path.glob("part-*") if f.stat().st_size]
    raw = bytearray(file.read_bytes())
    raw[-20] ^= 1
    for crc in path.glob(".*.crc"):
        crc.write_bytes(b"")
    file.write_bytes(bytes(raw))
    with pytest.raises(Exception, match="damaged"):
        token_file.read(spark, str(path)).collect()


def check_packing(got, want, capacity):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    ids_of = defaultdict(list)
    for k, ids in want:
        ids_of[k, len(ids)].append(ids)
    assert set(pieces) == set(ids_of)
    for key, own in pieces.items():
        crcs = Counter((r.start, r.length, r.ids_crc32) for r in own)
        cut = Counter()
        for ids in ids_of[key]:
            for at in range(0, len(ids), capacity):
                part = ids[at : at + capacity]
                cut[at, len(part), zlib.crc32(part.tobytes())] += 1
        assert crcs == cut
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in got), len(sequences)


def test_packing(spark, odd, odd_rows, empty, small):
    got = packing.pack(odd, WORDS).collect()
    check_packing(got, expected([(r[0], r[1]) for r in odd_rows], WORDS, 1), 2048)
    assert packing.pack(empty, WORDS).count() == 0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tokens, sequences = check_packing(packing.pack(docs, WORDS).collect(), expected(rows, WORDS, 1), 2048)
    assert sequences <= 1.03 * tokens / 2048 + 2


def test_packing_with_a_common_length(spark):
    texts = [(i, "w " * 299 if i % 3 else "w " * (50 + i)) for i in range(600)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = packing.pack(df, WORDS, buckets=8).collect()
    tokens, sequences = check_packing(got, expected(texts, WORDS, 1), 2048)
    assert sequences <= 1.05 * tokens / 2048 + 2


def test_patterns_cover_the_demand():
    rng = random.Random(1)
    for _ in range(20):
        sizes = np.array(sorted(rng.sample(range(1, 65), rng.randrange(1, 20))), dtype=np.int64)
        demand = np.array([rng.randrange(1, 300) for _ in sizes], dtype=np.int64)
        patterns, used = packing.solve_patterns(sizes, demand, 64)
        assert (patterns @ sizes <= 64).all() and (used @ patterns >= demand).all()


def test_knapsack():
    sizes, prices = np.array([3, 5, 7]), np.array([0.3, 0.55, 0.7])
    best, counts = packing.best_pattern(sizes, prices, 16)
    every = [
        (a * 0.3 + b * 0.55 + c * 0.7)
        for a in range(6)
        for b in range(4)
        for c in range(3)
        if 3 * a + 5 * b + 7 * c <= 16
    ]
    assert best == pytest.approx(max(every)) and counts @ prices == pytest.approx(best) and counts @ sizes <= 16


def test_bucket_count_does_not_change_the_pieces(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").filter(F.col("doc_id") < 60)
    runs = [
        Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in packing.pack(docs, WORDS, buckets=b).collect())
        for b in (1, 64)
    ]
    assert runs[0] == runs[1]
