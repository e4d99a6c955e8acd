"""Fingerprints and components against brute force."""

import random

import numpy as np
import xxhash
from weir.llm import simhash
from weir.llm.graph import components


def _fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(prints, budget=2):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= budget:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def _docs():
    random.seed(4)
    words = [f"w{i}é" for i in range(300)]
    docs = []
    for i in range(120):
        text = [random.choice(words) for _ in range(random.randint(0, 200))]
        docs.append((i, " ".join(text)))
        for j in range(random.randint(0, 3)):
            if text:
                text[random.randrange(len(text))] = random.choice(words)
            docs.append((1000 + 10 * i + j, " \n".join(text)))
    return docs + [(5, None), (6, ""), (7, "  \t "), (None, docs[0][1]), (8, docs[0][1]), (8, docs[0][1]), (9, "A  b")]


SCHEMA = "doc_id long, text string, fp string, root int"  # fp, root: extra columns with clashing names


def test_components_match_brute_force(spark):
    docs = _docs()
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df).collect()),
                 key=lambda r: (r[0] is None, r))
    prints = [(d, _fingerprint(t)) for d, t in docs]
    root = _components({f for _, f in prints})
    least = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    want = sorted(((d, f, least.get(root[f])) for d, f in prints), key=lambda r: (r[0] is None, r))
    assert got == want


def test_keep_one_row_of_each_component(spark):
    df = spark.createDataFrame([(*d, "x", 1) for d in _docs()], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    prints = [(d, _fingerprint(t)) for d, t in _docs()]
    root = _components({f for _, f in prints})
    least = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []


def test_long_text_in_segments(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "SEGMENT", 1000)
    assert simhash.fingerprint(text.encode()) == whole == _fingerprint(text)


def test_trie_walk_finds_every_link():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**63, 400, dtype=np.uint64) & np.uint64(0xFFFF0000000000FF)
    x = np.unique(np.concatenate([x, x[:100] ^ np.uint64(1 << 60), x[:50] ^ np.uint64(3)]))
    got = {(int(i), int(j)) for a, b in simhash.trie_links(x, None, 0, 2, leaf=4) for i, j in zip(a, b)}
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if int(x[i] ^ x[j]).bit_count() <= 2}
    assert got == want


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert set(got.values()) == {0, 500} and len(got) == 203
