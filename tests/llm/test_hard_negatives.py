"""Hard negatives against brute force: ties, hot labels and vectors, odd rows, many shards and blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodmill.llm import hard_negatives
from tools.compare import compare, connect

SCHEMA = "vec_id long, embedding array<float>, label int, shard string, block string, lists string, aid string"


def brute(rows, k=5, n=10):
    valid = []
    for own, vector, label in {(r[0], None if r[1] is None else tuple(r[1]), r[2]) for r in rows}:
        if None in (own, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        valid.append((own, label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for own, label, vector in (r for r in valid if r[0] % 100 == 0):
        def scored(keep):
            rows = [(-sum(a * b for a, b in zip(vector, v)), i) for i, lab, v in valid if len(v) == len(vector) and keep(i, lab)]
            return sorted(rows)

        negatives = scored(lambda i, lab: lab != label)
        for ps, positive in scored(lambda i, lab: lab == label and i != own)[:k]:
            inside = [(s, i) for s, i in negatives if 30 * -ps <= 100 * -s <= 90 * -ps][:n]
            out += [(own, positive, r, i, -ps, -s) for r, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, *("clash",) * 4) for r in rows], SCHEMA)
    valid = hard_negatives.valid_rows(df, "vec_id", "embedding", F.col("label"))
    found = hard_negatives.mine(valid, valid.filter("id % 100 = 0"), **options)
    return sorted(tuple(r) for r in found.collect())


def table(seed, n, dims, labels, round_to=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0.1, 0.3) for _ in range(dims)]
        rows.append((i, [round(x, round_to) if round_to is not None else float(np.float32(x)) for x in v], rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "block_anchors": 2}])
def test_equals_brute_force(spark, options):
    rows = table(1, 620, 6, 3)
    assert mined(spark, rows, **options) == brute(rows)


def test_ties_and_a_hot_vector(spark):
    rows = table(2, 500, 3, 2, round_to=0)
    rows += [(1000 + i, [1.0, 0.0, 1.0], 0) for i in range(300)]
    rows += rows[:50]
    assert mined(spark, rows, shard_rows=60) == brute(rows)


def test_odd_rows(spark):
    rows = table(3, 220, 4, 2)
    rows += [
        (None, [1.0] * 4, 1),
        (300, None, 1),
        (400, [1.0, None, 0.0, 0.0], 1),
        (500, [float("nan")] * 4, 0),
        (600, [float("inf"), 0.0, 0.0, 0.0], 0),
        (700, [0.5] * 4, None),
        (800, [0.0] * 4, 1),
        (900, [], 0),
        (901, [], 0),
        (902, [], 1),
        (1000, [0.3, 0.4], 0),
        (1001, [0.3, 0.5], 0),
        (1002, [0.2, 0.2], 5),
        (1100, [-5.0, 1.0, 0.0, 2.0], 7),
    ]
    assert mined(spark, rows) == brute(rows)


def test_empty_table_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []


def test_threshold_stops_early_and_loses_nothing():
    rng = np.random.default_rng(4)
    values = rng.integers(-300, 300, (4000, 3))
    lists = hard_negatives.build(np.arange(4000), np.zeros(4000, dtype=np.int64), values)
    scored = 0

    class Counting(np.ndarray):
        def __getitem__(self, key):
            nonlocal scored
            if isinstance(key, np.ndarray) and self.ndim == 2:
                scored += len(key)
            return super().__getitem__(key)

    counted = lists._replace(values=values.view(Counting))
    anchor = np.array([5, -7, 0])
    wanted = np.ones(4000, dtype=bool)
    truth = values @ anchor
    order = np.lexsort((np.arange(4000), -truth))
    window = (1000, 1500)
    inside = [i for i in order if window[0] <= truth[i] <= window[1]][:10]
    got = hard_negatives.first_rows(counted, anchor, wanted, [(float("-inf"), float("inf")), window], 10)
    assert [i for i, _ in got[0]] == list(order[:10])
    assert [i for i, _ in got[1]] == inside
    assert scored < 3500


def test_large_components_stay_exact():
    values = np.array([[1 << 24, 3], [1 << 24, 4], [(1 << 24) - 1, 5]])
    kind = hard_negatives.exact_type(2, 1 << 24, 1 << 24)
    lists = hard_negatives.build(np.arange(3), np.zeros(3, dtype=np.int64), values.astype(kind))
    got = hard_negatives.first_rows(lists, np.array([1 << 24, 1]), np.ones(3, dtype=bool), [(float("-inf"), float("inf"))], 3)
    assert got == [[(1, (1 << 48) + 4), (0, (1 << 48) + 3), (2, (1 << 48) - (1 << 24) + 5)]]


def test_query_matches_sql(spark, small):
    verdict, _, _ = compare(connect(small), spark, small, "op12_hard_negatives")
    assert verdict.startswith("ok"), verdict
