"""Near-duplicate vectors against brute force."""

import math
from collections import Counter

import numpy as np
import pytest
from weir.llm import itq


def _near(rng, x, low, high):
    """Partners at cosines between low and high."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=u.shape)
    side -= np.einsum("ij,ij->i", side, u)[:, None] * u
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(low, high, size=(len(u), 1))
    return (c * u + np.sqrt(1 - c * c) * side) * rng.uniform(0.1, 9, size=(len(u), 1))


def _data(d, n=900):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(n, d))
    hot = np.repeat(x[:1], n // 3, axis=0)  # a group of near copies
    x = np.concatenate([x, _near(rng, x[:300], 0.93, 0.97), _near(rng, x[300:500], 0.97, 0.9999), _near(rng, hot, 0.985, 0.995),
                        np.repeat(x[5:6], 60, axis=0), 3 * x[7:9]])
    return x[rng.permutation(len(x))].astype("float32")


def _cosines(x):
    x = x.astype(float)
    n = np.sqrt((x * x).sum(axis=1))
    return x @ x.T / n[:, None] / n[None, :]


@pytest.mark.parametrize("d", [3, 64, 80])
def test_bin_equals_brute_force_on_meeting_pairs(d, monkeypatch):
    x = _data(d, 300).astype(float)
    _, u = itq.unit(x)
    mean, projection = itq.learn_rotation(u)
    code = itq.codes(u, mean, projection)
    copies = np.arange(1, len(x) + 1)
    results = []
    for run in (1, 200, 1 << 16):
        monkeypatch.setattr(itq, "RUN", run)
        links, tied = np.zeros(len(x), np.int64), []
        for t in range(5):
            part = itq.Bin(x, code, copies, t, 5, 12, 0.95)
            part.compare(np.arange(len(x)), None, range(part.width))
            links += part.links
            tied += [(i, int(r)) for i, r in enumerate(part.label) if i != r]
        results.append((links.tolist(), _closure(len(x), tied)))
    far = code[:, None] ^ code[None, :]
    meet = (np.bitwise_count(far) <= 12) & np.any([itq.differing(far, *s) <= 1 for s in itq.substrings(5)], axis=0)
    ok = meet & (_cosines(x) >= 0.95) & ~np.eye(len(x), dtype=bool)
    want = ((ok @ copies).tolist(), _closure(len(x), list(zip(*np.nonzero(ok)))))
    assert results == [want] * 3
    two = itq.Bin(x, code, copies, 0, 5, 12, 0.95)  # two sides, as between blocks
    half = np.arange(len(x)) % 2 == 0
    two.compare(np.nonzero(half)[0], np.nonzero(~half)[0], range(two.width))
    first = ok & (itq.differing(far, *itq.substrings(5)[0]) <= 1) & (half[:, None] != half[None, :])
    assert two.links.tolist() == (first @ copies).tolist()


def _closure(n, edges):
    label = list(range(n))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return [find(i) for i in range(n)]


def test_codes_are_balanced_and_keep_near_vectors_near():
    rng = np.random.default_rng(1)
    _, u = itq.unit(rng.normal(size=(4000, 64)) + 0.5)
    mean, projection = itq.learn_rotation(u)
    code = itq.codes(u, mean, projection)
    ones = np.unpackbits(code.view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
    assert len(ones) == 64 and ones.min() > 0.4 and ones.max() < 0.6
    tables, radius = itq.calibrate(u, mean, projection, 0.95, 0.97)
    assert 3 <= tables <= 8 and 8 <= radius <= 16
    assert sum(w for _, w in itq.substrings(tables)) == 64


def test_query_against_brute_force(spark, monkeypatch):
    x = _data(64)
    n = len(x)
    rows = [(i + 10, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(9000, None), (9001, [0.0] * 64), (9002, [math.nan] * 64), (9003, [None] + [1.0] * 63), (9004, [math.inf] * 64),
           (None, x[0].tolist()), (9005, x[0].tolist()[:5]), (9006, [2 * c for c in x[0].tolist()[:5]]), (9005, x[1].tolist()),
           (9007, [])]
    df = spark.createDataFrame(rows + [(*r, 2) for r in odd], "vec_id long, embedding array<float>, links int")
    got = itq.near_duplicates(df).collect()
    assert Counter(r.vec_id for r in got) == Counter([r[0] for r in rows] + [r[0] for r in odd])
    mine = {r.vec_id: r for r in got}
    for i in (9000, 9001, 9002, 9003, 9004, 9007, None):
        assert (mine[i].n_links, mine[i].component_id, mine[i].kept) == (0, i, True)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id in (9005, 9006) and r.component_id == 9005) == [
        (9005, 1, 9005, True), (9006, 1, 9005, False)]
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    ok = (_cosines(x) >= 0.95) & ~np.eye(n, dtype=bool)
    exact = ok.sum(axis=1)
    ours = np.array([mine[i + 10].n_links for i in range(n)])
    assert (ours <= exact + 1).all()  # the copy of x[1] under 9005
    assert ours.sum() >= 0.95 * exact.sum()
    edge = ok & (_cosines(x) < 0.965)
    assert edge.sum() > 100
    roots = _closure(n, list(zip(*np.nonzero(ok))))
    same = np.mean([mine[i + 10].component_id == roots[i] + 10 for i in range(n)])
    assert same >= 0.9
    monkeypatch.setattr(itq, "BIN_ROWS", 64)  # many bins and blocks give the same
    monkeypatch.setattr(itq, "BLOCK_ROWS", 50)
    assert Counter(itq.near_duplicates(df).collect()) == Counter(got)


def test_empty_and_large_values(spark):
    schema = "vec_id long, embedding array<double>"
    assert itq.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, [1e300, 1e300]), (3, [1e-300, 1.01e-300]), (4, [-1e300, 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert got == {5: (1, 3), 3: (1, 3), 4: (0, 4)}
