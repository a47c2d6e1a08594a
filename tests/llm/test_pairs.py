"""Operators on pairs against brute force: SimHash, passages, neighbours."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from moodmill.llm import hnsw, simhash_dedup, substring_dedup
from moodmill.llm.components import components


def slow_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(small_texts, odd_rows):
    for text in [*(t["text"] for t in small_texts[:60]), *(r[1] for r in odd_rows if r[0] != 5), "A B c D É"]:
        assert simhash_dedup.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_equals_spark_hash(spark):
    df = spark.createDataFrame([("ab cd ef gh",)], "text string")
    row = df.select(F.xxhash64("text")).first()
    assert simhash_dedup.fingerprint("ab cd ef gh") == row[0] % (1 << 64)


def slow_components(values, budget):
    n = len(values)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def clustered(n, seed):
    """Distinct 64-bit values, some scattered, some in dense clusters and chains."""
    rng = random.Random(seed)
    values = {rng.getrandbits(64) for _ in range(n // 3)}
    for base in list(values)[:8]:
        value = base
        for _ in range(n // 24):
            value ^= 1 << rng.randrange(64)
            values.add(value)
            values.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return sorted(values)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_join(seed):
    values = clustered(600, seed)
    got = simhash_dedup.trie_components(np.array(values, dtype=np.uint64)[:, None], np.zeros(len(values), int), 4)
    assert got.tolist() == slow_components(values, 4)


@pytest.mark.parametrize(("group_rows", "agree"), [(4096, None), (8, None), (4096, 2), (8, 3), (4096, 4)])
def test_links_over_all_blocks(spark, group_rows, agree):  # 8: nearly every group is cut into chunks
    values = clustered(400, 3)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    labels = {r.node: r.label for r in components(simhash_dedup.links(df, 4, group_rows, agree)).collect()}
    want = slow_components(values, 4)
    sizes = Counter(want)
    got = {}
    for v, w in zip(signed, want, strict=True):
        assert (v in labels) == (sizes[w] > 1)
        got.setdefault(w, set()).add(labels.get(v, v))
    assert all(len(s) == 1 for s in got.values())


def test_near_duplicates_of_odd_rows(odd, odd_rows, empty):
    got = simhash_dedup.near_duplicates(odd).collect()
    prints = [slow_fingerprint(r[1]) for r in odd_rows if r[0] != 5]
    keys = [r[0] for r in odd_rows if r[0] != 5]
    root = slow_components(prints, 4)
    least = {}
    for k, w in zip(keys, root, strict=True):
        least[w] = min((x for x in (k, least.get(w)) if x is not None), default=None)
    want = Counter((k, p, least[w]) for k, p, w in zip(keys, prints, root, strict=True))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got if r.doc_id != 5) == want
    assert len(got) == len(odd_rows)
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    rng = random.Random(5)
    nodes = rng.sample(range(10_000), 300)
    edges = list(zip(nodes, nodes[1:], strict=False)) + [(20_000, 20_001), (20_001, 20_002), (30_000, 30_000)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    assert {got[n] for n in nodes} == {min(nodes)}
    assert got[20_002] == 20_000 and 30_000 not in got


def test_more_blocks_agree_as_entries_grow():
    sizes = [10, 10**6, 10**8, 10**10, 10**13]
    assert [simhash_dedup.must_agree(n, 4) for n in sizes] == [1, 2, 3, 4, 4]
    for agree in range(1, 5):
        orders = simhash_dedup.block_orders(4, agree)
        assert len(orders) == math.comb(4 + agree, agree)
        assert all(sum(size for _, size in order) == 64 for order in orders)
        fps = np.array([random.Random(1).getrandbits(64)] * len(orders), dtype=np.uint64)
        turned = simhash_dedup.reordered(fps, np.arange(len(orders)), orders)
        assert all(int(t).bit_count() == int(fps[0]).bit_count() for t in turned)


def kept_by_hand(rows):
    """The least (key, digest) of each component, null keys last."""
    root = slow_components([slow_fingerprint(text) for _, text in rows], 4)
    least = {}
    for (key, text), r in zip(rows, root, strict=True):
        row = (key is None, key or 0, hashlib.md5((text or "").encode()).hexdigest())
        least[r] = min(row, least.get(r, row))
    return Counter((None if null else key, digest) for null, key, digest in least.values())


def kept(df):
    found = simhash_dedup.keep_one(df)
    assert found.columns == df.columns
    return Counter((r.doc_id, hashlib.md5((r.text or "").encode()).hexdigest()) for r in found.collect())


def test_one_row_of_each_group_stays(spark, odd, odd_rows, empty):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for group in range(30):
        base = [word() for _ in range(400)]
        for copy in range(4):
            changed = list(base)
            for _ in range(copy):
                changed[rng.randrange(400)] = word()
            rows.append((rng.randrange(10**6), " ".join(changed)))
    rows += rows[:7] + [(None, rows[3][1]), (None, "alone"), (None, "alone"), (5, ""), (4, None), (3, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert kept(df) == kept_by_hand(rows)
    assert kept(odd) == kept_by_hand([r[:2] for r in odd_rows])
    assert simhash_dedup.keep_one(empty).count() == 0


def slow_removal(texts, window=35):
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for own in words:
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if count[tuple(own[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        left = b" ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((len(own), sum(gone), hashlib.sha256(left).hexdigest()))
    return out


def removal_rows():
    """Few different words, so that short repeats are everywhere; planted long ones; runs of a word."""
    rng = random.Random(11)
    text = lambda n: [rng.choice("abc") for _ in range(n)]
    passages = [text(n) for n in (34, 35, 36, 60, 120)]
    texts = []
    for i in range(60):
        parts = text(rng.randrange(80))
        parts += passages[i % 5] + text(rng.randrange(60))
        if i % 7 == 0:
            parts += ["run"] * rng.choice([30, 35, 36, 90])
        if i % 11 == 0:
            parts += passages[4] + text(3) + passages[4]
        texts.append(" ".join(parts))
    return [*texts, texts[0], texts[0].replace(" ", "\n"), None, "", "a b"]


def test_repeated_passages(spark, odd, odd_rows, empty):
    texts = removal_rows()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs, keys, source in (
        (df, list(range(len(texts))), texts),
        (odd, [r[0] for r in odd_rows], [r[1] for r in odd_rows]),
    ):
        want = Counter((k, *x) for k, x in zip(keys, slow_removal(source), strict=True))
        got = substring_dedup.remove_repeats(docs).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_symbols_are_the_same_inside_equal_stretches():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 5, 400).astype(np.uint64)
    starts = []
    for seed in (1, 2):
        left = np.random.default_rng(seed).integers(0, 5, 50 + seed).astype(np.uint64)
        words = np.r_[left, common, left[::-1]]
        place = substring_dedup.symbol_starts(words, np.zeros(len(words), int)) - len(left)
        inside = place[(place >= substring_dedup.REACH) & (place <= len(common) - substring_dedup.REACH)]
        starts.append(inside.tolist())
        assert np.diff(place).max() <= substring_dedup.SPAN
    assert starts[0] == starts[1]


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 16))
    vectors[100:400] = vectors[100]  # one vector that a third of the rows hold
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [1.0, None] * 8)]
    rows += [(None, vectors[0].tolist()), (2005, [1.0, 2.0]), (2006, [1.0, 4.0]), rows[5]]
    names = "id string, v string, shard string, dim string, graph string, place string, ids string"
    df = spark.createDataFrame([(*r, *("clash",) * 7) for r in rows], f"vec_id long, embedding array<double>, {names}")
    valid = hnsw.valid_vectors(df, "vec_id", "embedding")
    got = hnsw.nearest(valid.filter("id % 10 = 0 or id > 1000"), hnsw.index(valid, shard_rows=300)).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {*range(0, 900, 10), 2005, 2006}
    assert sorted(found[2005]) == [(1, 2006, pytest.approx(2.0))]
    hits = 0
    for q in range(0, 900, 10):
        apart = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        order = [int(i) for i in np.lexsort((np.arange(900), apart)) if i != q][:10]
        mine = sorted(found[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        assert all(math.isclose(s, apart[v], abs_tol=1e-12) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(order))
        if q in range(100, 400):
            assert [v for _, v, _ in mine] == order
    assert hits / 900 >= 0.9
    nothing = hnsw.valid_vectors(df.limit(0), "vec_id", "embedding")
    assert hnsw.nearest(nothing, hnsw.index(nothing)).count() == 0
