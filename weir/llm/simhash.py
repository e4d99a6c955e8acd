"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints are computed inside the scan's tasks (Arrow batches). Equal
fingerprints collapse first, so a group of copies of any size is one trie
entry. The trie's upper levels are spread over tasks as pairs of nodes whose
prefixes differ by no more than the error budget; below, one task walks the two
subtrees together, adds up differing bits, and leaves a pair of nodes as soon
as the budget is exceeded. A task emits only a spanning forest of its links, so
a dense cluster never becomes all its pairs. Components come from star
contractions over those edges, each round written to the shared folder.

Defined cases: a null or blank text has no words and gets fingerprint zero,
which links like any other; a null doc_id is kept, and a component's id is its
smallest non-null doc_id (null if there is none); repeated rows are each
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from weir.llm.common import give_back, id_and_bytes
from weir.llm.graph import components
from weir.session import scratch_path

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"  # what separates words
SEGMENT = 4 << 20  # a longer text is hashed in segments of about this many bytes


def _segments(text: bytes):
    """Whole words of `text`, a segment at a time."""
    at = 0
    while len(text) - at > SEGMENT:
        end = at + SEGMENT
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[at:end].split()
        at = end
    yield text[at:].split()


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles, each hashed by XXH64 with seed 42."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, n, tail = np.zeros(64, np.int64), 0, []

    def add(hashes: list[int]) -> None:
        nonlocal ones, n
        for i in range(0, len(hashes), 1 << 16):
            h = np.array(hashes[i:i + (1 << 16)], dtype="<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)

    for words in _segments(text.lower()):
        words = tail + words
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
            ends = (ends - 1)[shingle - 1:].tolist()
            add([digest(joined[a:b], 42) for a, b in zip(starts, ends)])
            tail = words[len(words) - shingle + 1:] if shingle > 1 else []
        else:
            tail = words
    if n == 0 and tail:
        add([digest(b" ".join(tail), 42)])
    return sum(1 << i for i in range(64) if 2 * int(ones[i]) > n)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `body_hash` (XXH64 of the text) and the 64-bit fingerprint `fp`
    (signed long) of every row."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, shingle) for x in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "body_hash", "fp"])
        give_back()

    rows = id_and_bytes(docs, id_col, text_col).select("doc_id", F.xxhash64("body").alias("body_hash"), "body")
    return rows.mapInArrow(run, "doc_id long, body_hash long, fp long")


# ---- the walk over two subtrees -------------------------------------------

def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component), one less than nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        nxt = label.copy()
        np.minimum.at(nxt, label[a], low)
        np.minimum.at(nxt, label[b], low)
        while True:
            jump = nxt[nxt]
            if np.array_equal(jump, nxt):
                break
            nxt = jump
        if np.array_equal(nxt, label):
            break
        label = nxt
    i = np.nonzero(label != np.arange(n))[0]
    return i, label[i]


def trie_links(x: np.ndarray, y: np.ndarray | None, start: int, budget: int, leaf: int = 64):
    """Yields index arrays (i, j) of links between two subtrees, given as
    sorted distinct keys below nodes of depth `start`; y None: x with itself.
    The budget left for each starting pair is what its prefixes leave."""
    same = y is None
    y = x if same else y
    if not len(x) or not len(y):
        return
    used = 0 if same or start == 0 else int(np.bitwise_count((x[0] ^ y[0]) >> np.uint64(64 - start)))
    if used > budget:
        return
    f = [np.array([v]) for v in (0, len(x), 0, len(y), used)]
    depth = start
    while len(f[0]):
        size = (f[1] - f[0]) * (f[3] - f[2])
        done = (size <= leaf) if depth < 64 else np.ones(len(size), bool)
        if done.any():
            yield from _compare(x, y, *(v[done] for v in f[:4]), same, budget)
            f = [v[~done] for v in f]
        if depth == 64 or not len(f[0]):
            break
        bit = np.uint64(63 - depth)
        cx = np.concatenate(([0], np.cumsum((x >> bit) & np.uint64(1), dtype=np.int64)))
        cy = cx if same else np.concatenate(([0], np.cumsum((y >> bit) & np.uint64(1), dtype=np.int64)))
        alo, ahi, blo, bhi, err = f
        am, bm = ahi - (cx[ahi] - cx[alo]), bhi - (cy[bhi] - cy[blo])
        one = same & (alo == blo) & (ahi == bhi)  # a node with itself: (1, 0) mirrors (0, 1)
        kids = [(alo, am, blo, bm, err, None), (am, ahi, bm, bhi, err, None),
                (alo, am, bm, bhi, err + 1, None), (am, ahi, blo, bm, err + 1, ~one)]
        parts = []
        for a0, a1, b0, b1, e, only in kids:
            keep = (a1 > a0) & (b1 > b0) & (e <= budget)
            if only is not None:
                keep &= only
            parts.append([v[keep] for v in (a0, a1, b0, b1, e)])
        f = [np.concatenate(v) for v in zip(*parts)]
        depth += 1


def _compare(x, y, alo, ahi, blo, bhi, same, budget, at_once: int = 1 << 20):
    """Direct comparison of all pairs below the given pairs of nodes."""
    size = (ahi - alo) * (bhi - blo)
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(np.cumsum(size[i:]), at_once)) + i)
        s = size[i:j]
        base = np.repeat(np.cumsum(s) - s, s)
        k = np.arange(int(s.sum())) - base
        wide = np.repeat(bhi[i:j] - blo[i:j], s)
        a = np.repeat(alo[i:j], s) + k // wide
        b = np.repeat(blo[i:j], s) + k % wide
        hit = np.bitwise_count(x[a] ^ y[b]) <= budget
        if same:
            hit &= a < b
        if hit.any():
            yield a[hit], b[hit]
        i = j


def _permuted(fp: np.ndarray, order: list[int]) -> np.ndarray:
    """Bit order[0] of fp becomes the highest, and so on."""
    out = np.zeros(len(fp), np.uint64)
    for k, bit in enumerate(order):
        out |= ((fp >> np.uint64(bit)) & np.uint64(1)) << np.uint64(63 - k)
    return out


def hamming_links(prints: DataFrame, budget: int = 2, node_rows: int = 8192, max_depth: int = 16) -> DataFrame:
    """Links between distinct `fp` values at `budget` or fewer differing bits,
    as edges (a, b) of spanning forests; the links' closure is whole."""
    ones = [F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(64)]
    row = prints.agg(F.count("fp").alias("n"), *ones).first()
    n = row["n"] or 0
    # the most even bits first, so that upper nodes are of like size
    order = sorted(range(64), key=lambda i: (abs(2 * (row[f"b{i}"] or 0) - n), i))
    depth = min(max_depth, max(4, math.ceil(math.log2(max(n, 1) / node_rows)) if n else 4))
    node = F.lit(0)
    for k in range(depth):
        node = node + F.shiftleft(F.shiftrightunsigned("fp", order[k]).bitwiseAND(F.lit(1)).cast("int"), depth - 1 - k)
    flips = [0] + [sum(1 << i for i in c) for r in range(1, budget + 1) for c in _choose(depth, r)]
    placed = (
        prints.select("fp", node.alias("own"))
        .withColumn("flip", F.explode(F.array(*[F.lit(v) for v in flips])))
        .withColumn("other", F.col("own").bitwiseXOR(F.col("flip")))
        .select("fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own")
    )

    def walk(key, table):
        lo, hi = (k.as_py() for k in key)
        fp = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy()
        sides = []
        for node_id in {lo, hi}:
            mine = fp[own == node_id]
            keys = _permuted(mine, order)
            at = np.argsort(keys)
            sides.append((keys[at], mine[at]))
        same = lo == hi
        (x, fx), (y, fy) = sides[0], sides[-1]
        ea, eb, held = [], [], 0
        values = fx if same else np.concatenate([fx, fy])

        def reduced():
            return _forest(np.concatenate(ea), np.concatenate(eb), len(values))

        for i, j in trie_links(x, None if same else y, depth, budget):
            ea.append(i)
            eb.append(j if same else j + len(fx))
            held += len(i)
            if held > 1 << 20:
                i, j = reduced()
                ea, eb, held = [i], [j], 0
        if not ea:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        i, j = reduced()
        return pa.table({"a": values[i].view(np.int64), "b": values[j].view(np.int64)})

    return placed.groupBy("lo", "hi").applyInArrow(walk, "a long, b long")


def _choose(n: int, r: int):
    from itertools import combinations

    return combinations(range(n), r)


def _components(docs: DataFrame, shingle: int, budget: int, id_col: str, text_col: str):
    """(prints, linked): every row's fingerprint, and every distinct one's root."""
    spark = docs.sparkSession
    path = scratch_path(spark, "simhash")
    # fingerprints are read again by several steps: written once, narrow
    fingerprints(docs, shingle, id_col, text_col).write.mode("overwrite").parquet(path)
    prints = spark.read.parquet(path)
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(hamming_links(distinct.select("fp"), budget))
    linked = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    return prints, linked


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id for every row of `docs`."""
    prints, linked = _components(docs, shingle, budget, id_col, text_col)
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = linked.join(least, "root").select(F.col("fp").alias("named_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("named_fp")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """`docs` with one row of each component: the smallest id (null ids last),
    and of rows repeated under it the one whose text hashes smallest."""
    prints, linked = _components(docs, shingle, budget, "doc_id", "text")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("body_hash").alias("h"))
    first = prints.groupBy("fp").agg(F.min(order).alias("o"))
    kept = first.join(linked.select(F.col("fp").alias("linked_fp"), "root"), F.col("fp") == F.col("linked_fp")).groupBy(
        "root").agg(F.min("o").alias("o")).select(_key(F.col("o.i")).alias("kept_id"), F.col("o.h").alias("kept_hash"))
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(
        *columns, _key(F.col("doc_id").cast("long")).alias("row_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("row_hash"))
    own = (F.col("row_id") == F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash"))
    one = rows.join(kept, own, "left_semi").dropDuplicates(["row_id", "row_hash"])
    return one.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _key(doc_id):
    """An id as a join key that a null id has too."""
    return F.coalesce(doc_id, F.lit(2**63 - 1))
