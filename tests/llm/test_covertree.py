"""Hard negatives against brute force; the cover tree's own rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from weir.llm import covertree


def _clusters(rng, n, d, near=0.2):
    heads = rng.normal(size=(max(1, n // 20), d))
    return np.floor(256 * (heads[rng.integers(len(heads), size=n)] + near * rng.normal(size=(n, d))))


@pytest.mark.parametrize("near", [0.0, 0.2, 5.0])
def test_tree_covers_separates_and_bounds(near):
    rng = np.random.default_rng(3)
    x = _clusters(rng, 600, 12, near)
    tree = covertree.CoverTree(x)
    seen = []

    def members(node):
        if tree.points[node] is not None:
            return list(tree.points[node])
        a, b = tree.children[node]
        heads = tree.lifted[tree.centre_of[a:b]]
        apart = np.sqrt(np.maximum(2 - 2 * heads @ heads.T, 0)) + 9 * np.eye(b - a)
        covering = max(tree.radius[i] for i in range(a, b))
        assert covering < tree.radius[node] + 1e-7 and apart.min() >= covering - 1e-6
        return [i for c in range(a, b) for i in members(c)]

    for node in range(len(tree.centre)):
        own = members(node)
        away = np.linalg.norm(tree.lifted[own] - tree.lifted[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-7
        q = np.floor(256 * rng.normal(size=12))
        room = np.linalg.norm(q) * (tree.radius_of[node] + covertree.SLACK * tree.top_norm)
        assert np.abs(x[own] @ q - x[tree.centre[node]] @ q).max() <= room
        if node == 0:
            seen = own
    assert sorted(seen) == list(range(600))


def test_search_is_exact_and_skips():
    rng = np.random.default_rng(4)
    x = _clusters(rng, 2000, 16, 0.1)
    tree, ids = covertree.CoverTree(x), rng.permutation(2000).astype(np.int64)
    asked = 0
    for _ in range(50):
        q = x[rng.integers(2000)]
        score = (x @ q).astype(np.int64)
        open_to = rng.random(2000) < 0.7
        low = np.array([int(score.max() * f) for f in (0.5, 0.2, 0.9)], object)
        high = np.array([int(score.max() * f) for f in (0.8, 0.3, 0.1)], object)
        window, found, got, verified = tree.search(q, 4, low, high, ids, open_to)
        asked += verified
        want = set()
        for w in range(3):
            at = [i for i in range(2000) if open_to[i] and low[w] <= score[i] <= high[w]]
            want |= {(w, ids[i], score[i]) for i in sorted(at, key=lambda i: (-score[i], ids[i]))[:4]}
        assert set(zip(window, found, got)) == want
    assert asked < 50 * 2000 * 0.7 * 0.5  # nodes outside the windows are skipped


def _expected(rows, k=5, m=3):
    out = set()
    for a, av, al in rows:
        if a % 50:
            continue
        scored = [(sum(p * q for p, q in zip(av, v)), i, lab == al) for i, v, lab in rows if i != a and len(v) == len(av)]
        scored = [(max(-(2**63), min(2**63 - 1, s)), i, same) for s, i, same in scored]
        for ps, p in sorted(((s, i) for s, i, same in scored if same), key=lambda t: (-t[0], t[1]))[:k]:
            fit = sorted(((-s, i) for s, i, same in scored if not same and 50 * ps <= 100 * s <= 95 * ps))[:m]
            out |= {(a, p, r + 1, i, ps, -s) for r, (s, i) in enumerate(fit)}
    return out


@pytest.mark.parametrize("d", [3, 16])
def test_equals_brute_force(spark, d):
    rng = np.random.default_rng(d)
    x = (_clusters(rng, 700, d, 0.5) / 256).astype("float32").tolist()
    for i in range(0, 200, 3):
        x[i] = x[0]  # ties
    rows = [(i, v, int(rng.integers(3)) if i % 4 else 1) for i, v in enumerate(x)]
    odd = [[math.nan] + x[0][1:], [None] + x[0][1:], [math.inf] + x[0][1:], None]
    rows += [(1000 + 50 * i, v, 1) for i, v in enumerate(odd)] + [(None, x[1], 1), (1500, x[1], None), (1550, x[1][:2], 1),
                                                                  (1551, x[2][:2], 2), (1552, x[2][:2], 1), (1600, [0.0] * d, 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, score string")
    got = covertree.hard_negatives(df, F.col("vec_id") % 50 == 0, F.col("label")).collect()
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v], lab) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    assert {tuple(r) for r in got} == _expected(good) and len(got) == len(_expected(good))


def test_beyond_64_bits_and_empty(spark):
    rows = [(0, [3e18, 1.0], 1), (1, [3e18, 0.0], 1), (2, [2.0, 0.0], 2), (3, [1.5, 7.0], 2), (4, [-3e18, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = covertree.hard_negatives(df, F.col("vec_id") == 0, F.col("label"), scale=1).collect()
    assert [(r.positive_id, r.negative_id, r.positive_score, r.negative_score) for r in got] == [
        (1, 2, 2**63 - 1, 6 * 10**18)] or not got
    assert {tuple(r) for r in got} == _expected([(i, [int(c // 1) for c in v], lab) for i, v, lab in rows])
    assert covertree.hard_negatives(df.limit(0), F.col("vec_id") == 0, F.col("label")).collect() == []
    assert covertree.hard_negatives(df, F.col("vec_id") == 9, F.col("label")).collect() == []


def test_a_search_that_cannot_prune_scores_many_rows_at_once():
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (1000, 32)).astype(float)
    tree, ids, calls = covertree.CoverTree(x), np.arange(1000), []
    plain = tree.scores
    tree.scores = lambda q, rows: (calls.append(len(rows)), plain(q, rows))[1]
    exact = (x @ x[0]).astype(int)
    low, high = np.array([-10**6, 0], object), np.array([10**9, 40_000], object)
    window, found, score, _ = tree.search(x[0], 3, low, high, ids, ids != 0)
    for w, (a, b) in enumerate(zip(low, high)):
        inside = [i for i in range(1, 1000) if a <= exact[i] <= b]
        assert sorted(found[window == w]) == sorted(sorted(inside, key=lambda i: (-exact[i], i))[:3])
    assert len(calls) < 100
