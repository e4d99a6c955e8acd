"""Exact top-k and nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from weir.llm import ann, topk


def _rows(rng, n, d, copies=0):
    x = rng.normal(size=(n, d)).astype("float32").tolist()
    for i in range(copies):
        x[3 * i] = x[0]
    rows = [(i, v, 1) for i, v in enumerate(x)]
    odd = [[float("nan")] + x[0][1:], [None] + x[0][1:], [float("inf")] + x[0][1:], None, [0.0] * d, x[1][:3]]
    return rows + [(1000 + 100 * i, v, 2) for i, v in enumerate(odd)] + [(None, x[2], 3), (7, x[7], 4)]


SCHEMA = "vec_id long, embedding array<float>, score int"  # score: an extra column with a clashing name


def _good(rows, zero):
    ok = [(i, v) for i, v, _ in rows if i is not None and v is not None
          and all(c is not None and math.isfinite(c) for c in v) and (zero or any(v))]
    return ok


@pytest.mark.parametrize("copies", [0, 60])
def test_topk_is_exact(spark, copies):
    rows = _rows(np.random.default_rng(1), 300, 8, copies)
    got = topk.exact_topk(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, k=5).collect()
    whole = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in _good(rows, True)]
    want = set()
    for q, x in {(i, tuple(v)) for i, v in whole if i % 100 == 0}:
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q and len(x) == len(y))[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_topk_beyond_64_bits_and_empty(spark):
    rows = [(0, [3e18, 1.0]), (1, [3e18, 2.0]), (2, [-3e18, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.score) for r in topk.exact_topk(df, F.col("vec_id") == 0, scale=1).collect()}
    assert got == {(1, 2**63 - 1), (2, -(2**63))}
    assert topk.exact_topk(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_nearest_scores_order_and_recall(spark):
    rows = _rows(np.random.default_rng(2), 1500, 16, 30)
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, k=10).collect()
    vectors = [(i, np.array(v, "float32").astype(float)) for i, v in _good(rows, False)]
    of = {}
    for r in got:
        of.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q, x in vectors:
        if q % 20:
            continue
        exact = {}
        for i, y in vectors:
            if i != q and len(x) == len(y):
                s = 0.0
                for a, b in zip(x, y):
                    s += a * b
                exact.setdefault(i, []).append(s)
        mine = sorted(of.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1))
        assert all(r.score in exact[r.vec_id] for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        near = sorted((-s, i) for i, ss in exact.items() for s in ss)[:10]
        hit += len({r.vec_id for r in mine} & {i for _, i in near})
        total += len({i for _, i in near})
    assert hit >= 0.9 * total
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_balanced_parts_stay_balanced():
    x = np.random.default_rng(3).normal(size=(512, 8))
    part = ann.balanced_parts(x, ann.neighbour_graph(x), 8)
    assert np.bincount(part, minlength=8).max() <= math.ceil(1.1 * 512 / 8)


def test_sorted_lists_stop_early_and_stay_exact():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.normal(size=(4000, 24))).astype(np.int64)
    x[rng.integers(4000, size=300)] = x[3]  # ties
    lists = topk.SortedLists(rng.permutation(4000).astype(np.int64), x)
    share = []
    for i in range(40):
        q = x[i] if i % 2 else np.floor(1024 * rng.normal(size=24)).astype(np.int64)
        want = sorted((-int(s), int(j)) for s, j in zip(lists.x @ q, lists.ids) if j != i)
        floor = -want[19][0]  # as known from other candidates
        for f in (None, floor, -want[2][0], -want[0][0] + 1):
            ids, score, read = lists.top(i, q, 10, f)
            best = [w for w in want if f is None or -w[0] >= f][:10]
            assert [(-int(s), int(j)) for s, j in zip(score, ids)] == best
            share.append(read / x.size)
    assert min(share) < 0.6 and np.mean(share) < 0.9
