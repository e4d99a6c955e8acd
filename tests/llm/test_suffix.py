"""Removal of repeated 100-byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from weir.llm import suffix


def _tie(text):
    """Rows of one id are ordered by a signed 64-bit hash of their text."""
    return int(np.uint64(xxhash.xxh64_intdigest(text, seed=42)).astype(np.int64))


def _removed(docs, width=100):
    seen, out = set(), []
    for d, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, _tie((r[1] or "").encode()))):
        b = (text or "").encode()
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            s = b[i:i + width]
            if s in seen:
                mask[i:i + width] = True
            seen.add(s)
        spans = int((np.diff(np.r_[0, mask.astype(int), 0]) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        out.append((d, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _docs(seed):
    random.seed(seed)
    words = ["ab", "the", "of", "ción", "x", "lorem", "zzz", "\0"]
    para = lambda n: " ".join(random.choice(words) for _ in range(n))
    shared = [para(random.randint(15, 80)) for _ in range(8)]
    docs = []
    for i in range(120):
        parts = [random.choice([para(random.randint(0, 60)), random.choice(shared), "aaaa" * random.randint(0, 60),
                                random.choice(shared)[random.randint(0, 30):][:random.randint(90, 200)]])
                 for _ in range(random.randint(0, 5))]
        docs.append((i, "".join(parts)))
    docs += [(1000 + i, docs[i][1]) for i in range(20)] + [(5, None), (5, ""), (7, docs[7][1])]
    docs += [(None, shared[0]), (None, shared[0]), (3000, "é" * 99), (3001, "é" * 150)]
    hot = para(60)  # a passage of most documents, with other text around it
    return docs + [(2000 + i, para(random.randint(20, 50)) + hot + para(random.randint(20, 50))) for i in range(150)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 1 << 13)
    docs = _docs(seed)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, block string")
    got = sorted((tuple(r) for r in suffix.remove_repeats(df).collect()), key=repr)
    assert got == _removed(docs)


def test_hot_ids_lie_in_many_blocks(spark, monkeypatch):
    """Of the rows, a third have a null id and a third one id; a text longer than a block."""
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 1 << 12)
    monkeypatch.setattr(suffix, "RANGE_BYTES", 1 << 12)
    docs = [((None, 9, i)[i % 3], t) for i, (_, t) in enumerate(_docs(3))]
    docs.append((None, "".join(t or "" for _, t in docs[:40])))
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, tie int")
    got = sorted((tuple(r) for r in suffix.remove_repeats(df).collect()), key=repr)
    assert got == _removed(docs)


def test_text_form_keeps_columns(spark):
    docs = [(1, "p" * 50 + "q" * 60 + "é" * 40, "en", 150, 9), (2, "p" * 50 + "q" * 60 + "é" * 40, "en", 150, 9),
            (3, None, "fr", None, 9), (4, "short", None, 5, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, n_chars long, removed int")
    out = {r.doc_id: r for r in suffix.remove_repeats(df, text=True).collect()}
    assert suffix.remove_repeats(df, text=True).columns == df.columns
    assert out[1].text == docs[0][1] and out[1].n_chars == 150 and out[2].text == "" and out[2].n_chars == 0
    assert out[3].text is None and out[3].n_chars is None and out[4].text == "short" and out[4].removed == 9


def test_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_scan_in_pieces_has_the_same_windows(monkeypatch):
    random.seed(3)
    text = bytes(random.choice(b"abc ") for _ in range(5000))

    def windows():
        row, p, a, b = suffix.anchors([text])
        return {(s, int(q)) for q, i, j in zip(p, a, b) for s in range(i, j + 1)}

    whole = windows()
    monkeypatch.setattr(suffix, "SCAN_BYTES", 700)
    assert windows() == whole and len(whole) == len(text) - suffix.WIDTH + 1


def test_loser_tree_merges_with_common_prefixes():
    random.seed(6)
    runs = []
    for _ in range(7):
        strings = sorted(bytes(random.choice(b"ab") for _ in range(6)) for _ in range(random.randint(0, 40)))
        rows = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, 6)
        lcp, tails = suffix.front_code(rows) if strings else (b"", b"")
        runs.append(suffix.front_decode(lcp, tails, 6))
        assert runs[-1][1] == strings
    run, at, lcp = suffix.merge_runs(runs)
    merged = [runs[r][1][i] for r, i in zip(run, at)]
    assert merged == sorted(s for r in runs for s in r[1])
    for x, y, h in zip(merged, merged[1:], lcp[1:]):
        assert x[:h] == y[:h] and (h == 6 or x[h] != y[h])
