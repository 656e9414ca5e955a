"""Hard negatives against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from changefeed.llm import gnat, queries
from changefeed.llm.oracle import ORACLE_SQL
from compare import compare
from conftest import SF_CHECK


def _brute(rows, window=(80, 100)):
    take = []
    for uid, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        take.append((uid, i, label, [math.floor(256 * x) for x in v]))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = Counter()
    for uid, i, label, v in take:
        if i is None or i % 100:
            continue
        score = [(sum(a * b for a, b in zip(v, w)), j, k == label) for u, j, k, w in take if u != uid]
        best = sorted([s for s in score if s[2]], key=key)[:5]
        for p, pid, _ in best:
            fit = [s for s in score if not s[2] and window[0] * p <= 100 * s[0] <= window[1] * p]
            for rank, (n, nid, _) in enumerate(sorted(fit, key=key)[:5], 1):
                out[i, pid, rank, nid, p, n] += 1
    return out


def _mined(spark, rows, monkeypatch, **small):
    for name, value in small.items():
        monkeypatch.setattr(gnat, name, value)
    df = spark.createDataFrame([(i, v, k, 1, "x") for i, v, k in rows],
                               "vec_id long, embedding array<float>, label int, uid int, leaf string").repartition(3)
    return Counter(tuple(r) for r in gnat.mine(gnat.prepared(df), fanout=small.get("FANOUT", 4)).collect())


def _rows(n, seed, dim=6):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(10, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(10))
        v = (centers[label] + rng.normal(size=dim)).astype(np.float32)
        out.append((i, [float(x) for x in v / np.linalg.norm(v)], label))
    return out


def test_equal_to_brute_force_in_small_blocks(spark, monkeypatch):
    rows = _rows(900, 1)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(300)]  # many equal vectors and ties
    got = _mined(spark, rows, monkeypatch, ROWS_PER_BLOCK=50, ANCHORS_PER_BLOCK=2, LEAF_SAMPLE=8, SAMPLE_VALUES=1200)
    assert got == _brute(rows) and sum(got.values()) > 100


def test_nulls_odd_numbers_and_empty(spark, monkeypatch):
    rows = _rows(120, 2)
    rows += [(None, rows[3][1], rows[3][2]), (500, None, 1), (600, [0.5, None], 1), (700, [float("nan")] * 6, 2),
             (800, [float("inf")] * 6, 2), (900, [1.0] * 6, None), (1100, [], 3), (1200, [1.0, -0.25], 4),
             (-100, [-1e-20] * 6, 5), (1300, [0.0] * 6, 6), (1301, [0.0] * 6, 6), (1302, [0.0] * 6, 7)]
    assert _mined(spark, rows, monkeypatch) == _brute(rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert gnat.mine(gnat.prepared(empty)).count() == 0


def test_large_numbers_stay_exact(spark, monkeypatch):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 20 - i % 3), 1.0], i % 3) for i in range(60)]
    assert _mined(spark, rows, monkeypatch) == _brute(rows)
    a = np.array([[2.0 ** 40, 1.0]])
    assert gnat.scores(a, a)[0][0] == np.iinfo(np.int64).max


def test_cells_left_out_hold_nothing():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 8))
    x = np.floor(256 * (centers[rng.integers(12, size=4000)] + 0.1 * rng.normal(size=(4000, 8))))
    tree = gnat.Tree(x[:800], 6)
    leaf = tree.place(x)
    rows = [(node, cell, i, a, b) for node, cell, lo, hi, s, g in tree.measured(x, leaf)
            for i, a, b in [*zip(range(len(lo)), lo, hi), (-1, s, g)]]
    tree.learn(rows)
    q = x[::100]
    found = gnat.scores(q, x)
    low = np.sort(found, axis=1)[:, -20].astype(float)
    high = np.sort(found, axis=1)[:, -5].astype(float)
    met = defaultdict(set)
    for i, k in zip(*tree.leaves(q, low, high)):
        met[int(i)].add(int(k))
    for i in range(len(q)):
        needed = set(leaf[(found[i] >= low[i]) & (found[i] <= high[i])].tolist())
        assert needed <= met[i]
    assert sum(map(len, met.values())) < 0.5 * len(q) * len(np.unique(leaf))


@pytest.mark.parametrize("name", ["op12_hard_negatives"])
def test_query_matches_sql(spark, duck_check, name):
    ok, msg = compare(queries.QUERIES[name](spark, SF_CHECK), duck_check, ORACLE_SQL[name])
    assert ok, msg
