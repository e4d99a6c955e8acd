"""Context-tree weighting over bytes.

Every byte is eight binary decisions. For each decision and each context of up
to `DEPTH` preceding bytes a Krichevsky-Trofimov estimator counts zeros and ones
over all training texts, and a node's weighted probability is half its own and
half the product of its children's, over all depths. The trained tree predicts
with the posterior weights this gives: from the root down, a node's own estimate
counts by how much of the training evidence it explains, a context never seen in
training predicts evenly. The score of a text is the sum over its bytes, and one
end mark, of log10 of the predicted probability.

The corpus never meets in one place. Blocks of documents count their distinct
(context, byte) grams and words; a shard gathers all grams whose last three context
bytes hash to it, which is whole subtrees from depth 3 on, weights them, and
answers every block with the log probabilities of its grams. Contexts of two bytes
are summed over the shards that hold their children, in groups, and returned to
those shards alone; depths 0 and 1, at most 257 contexts, are summed over all and
sent to each. What is gathered grows with the corpus, and so does the number of
shards.

Defined cases: a null text is empty and has only its end mark; a null doc_id is
scored and trains like any other; repeated rows count each; a text longer than a
block is a block of its own, scanned whole; further columns of any name stay out of
the plan; an empty table gives an empty result; with no training text every decision
is even.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from weir.llm.common import body_bytes, chunks, id_and_bytes, id_fold, in_blocks, shuffle_partitions

DEPTH = 5
BLOCK_BYTES = SHARD_BYTES = 8 << 20  # text per block, and per shard
PAIR_GROUPS = 64  # groups of two-byte contexts, of which there are at most 65,536
SCAN_BYTES = 2 << 20
START, END = 0xFE, 0xFF  # never bytes of UTF-8
TOP = ("zeros", "ones", "below")
END_WORD = 0x9E3779B97F4A7C15  # stands for the end token among word hashes


# ---- counting ---------------------------------------------------------------

def gram_keys(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One number per byte and end mark: its context, nearest byte first, then
    the byte; and the body each belongs to."""
    pad = bytes([START]) * DEPTH
    data = np.frombuffer(b"".join([pad + b + bytes([END]) for b in bodies]) + b"\0" * 8, np.uint8)
    lengths = np.array([len(b) + 1 for b in bodies], np.int64)
    owner = np.repeat(np.arange(len(bodies)), lengths)
    at = np.arange(int(lengths.sum())) + owner * DEPTH
    raw = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))[at]
    context = raw & np.uint64((1 << 8 * DEPTH) - 1)
    byte = (raw >> np.uint64(8 * DEPTH)) & np.uint64(0xFF)
    return context << np.uint64(8) | byte, owner


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the three nearest context bytes: whole subtrees below depth 3."""
    top = keys >> np.uint64(8 * (DEPTH - 3) + 8)
    return ((top * np.uint64(0x9E3779B1)) >> np.uint64(7)) % np.uint64(shards)


def sorted_counts(keys: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts (or sums of weights)."""
    if weight is not None:
        at = np.argsort(keys)
        keys, weight = keys[at], weight[at]
    else:
        keys = np.sort(keys)
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0] if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(keys))) if weight is None else (
        np.add.reduceat(weight, first) if len(first) else np.zeros(0, np.int64))
    return keys[first], n


def words_of(body: bytes) -> list[bytes]:
    return body.lower().split()  # A-Z; cut at \\x20 and \\x09-\\x0D


def word_hashes(words) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


# ---- the tree ---------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov log probability of so many zeros and ones."""
    a, b = zeros.astype(float), ones.astype(float)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - math.log(math.pi)


def nodes_at(keys: np.ndarray, n: np.ndarray, depth: int):
    """Binary decision nodes of contexts of `depth` bytes: sorted node keys
    (context, partial byte), their zeros and ones, and for each of the eight
    decisions of each gram its node."""
    drop = np.uint64(8 * (DEPTH - depth) + 8)
    context, byte = keys >> drop, keys & np.uint64(0xFF)
    partial = [(np.uint64(1 << k) | byte >> np.uint64(8 - k)) for k in range(8)]
    all_nodes = np.concatenate([context << np.uint64(8) | p for p in partial])
    node, inverse = np.unique(all_nodes, return_inverse=True)
    bit = np.concatenate([(byte >> np.uint64(7 - k)) & np.uint64(1) for k in range(8)]).astype(bool)
    weight = np.tile(n, 8).astype(float)
    zeros = np.bincount(inverse, np.where(bit, 0, weight), len(node))
    ones = np.bincount(inverse, np.where(bit, weight, 0), len(node))
    return node, zeros, ones, inverse.reshape(8, -1)


def weigh(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's weighted log probability and its own estimate's posterior weight."""
    total = np.logaddexp(own, children) - math.log(2)
    return total, np.exp(own - math.log(2) - total)


def subtree(keys: np.ndarray, n: np.ndarray):
    """Depths DEPTH to 3 of one shard: by depth (nodes, zeros, ones, weight of the
    own estimate, gram index), and the weighted log probabilities at depth 3."""
    levels, below = {}, None
    for depth in range(DEPTH, 2, -1):
        node, zeros, ones, index = nodes_at(keys, n, depth)
        own = log_kt(zeros, ones)
        if below is None:
            total, share = own, np.ones(len(node))
        else:
            total, share = weigh(own, np.bincount(np.searchsorted(node, parents(below[0])), below[1], len(node)))
        levels[depth] = (node, zeros, ones, share, index)
        below = (node, total)
    return levels, below


def parents(node: np.ndarray) -> np.ndarray:
    """A parent's key lacks its child's farthest context byte."""
    return (node >> np.uint64(16)) << np.uint64(8) | node & np.uint64(0xFF)


def summed(node: np.ndarray, *values: np.ndarray):
    """Distinct nodes, sorted, and the sums of their values."""
    one, inverse = np.unique(node, return_inverse=True)
    return one, *(np.bincount(inverse, v, len(one)) for v in values)


def log_probabilities(keys: np.ndarray, levels, top) -> np.ndarray:
    """log10 of each gram's predicted probability, all depths mixed."""
    byte = keys & np.uint64(0xFF)
    out = np.zeros(len(keys))
    for k in range(8):
        bit = ((byte >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        p = np.full(len(keys), 0.5)
        for depth in range(DEPTH, -1, -1):
            if depth >= 3:
                _, zeros, ones, share, index = levels[depth]
                i = index[k]
            else:
                node, zeros, ones, share = top[depth]
                context = keys >> np.uint64(8 * (DEPTH - depth) + 8) if depth else np.zeros(len(keys), np.uint64)
                i = np.searchsorted(node, context << np.uint64(8) | np.uint64(1 << k) | byte >> np.uint64(8 - k))
            n = zeros[i] + ones[i]
            own = (np.where(bit, ones[i], zeros[i]) + 0.5) / (n + 1)  # even where training never came
            p = share[i] * own + (1 - share[i]) * p
        out += np.log10(p)
    return out


def top_of(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
    """Depths 1 and 0 from the sums over all shards by (nearest byte, partial
    byte), sorted; `below`: log probabilities weighted at depth 2."""
    total, share = weigh(log_kt(zeros, ones), below)
    root, z0, o0, total0 = summed(node & np.uint64(0xFF), zeros, ones, total)
    _, share0 = weigh(log_kt(z0, o0), total0)
    return {1: (node, zeros, ones, share), 0: (root, z0, o0, share0)}


# ---- the job ----------------------------------------------------------------

def _bytes(x: np.ndarray) -> bytes:
    """Compressed after transposing the bytes: sorted keys share their high ones."""
    import zstandard

    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T))


def _array(x: bytes, dtype: str) -> np.ndarray:
    import zstandard

    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).view(dtype).ravel()


def _gathered(bodies: list[bytes], train: list[bool]):
    """Distinct grams and words of some bodies with their training counts."""
    keys, counts, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], {}
    for i, j in chunks(bodies, SCAN_BYTES):
        k, owner = gram_keys(bodies[i:j])
        learns = np.array(train[i:j], bool)[owner]
        for part, on in ((k[learns], 1), (k[~learns], 0)):
            key, n = sorted_counts(part)
            keys.append(key)
            counts.append(n * on)
        if len(keys) > 16:
            keys, counts = map(lambda v: [v], sorted_counts(np.concatenate(keys), np.concatenate(counts)))
        for body, on in zip(bodies[i:j], train[i:j]):
            for w in words_of(body):
                words[w] = words.get(w, 0) + on
    key, n = sorted_counts(np.concatenate(keys), np.concatenate(counts))
    return key, n, words


def score(docs: DataFrame, held_out=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row; rows where `held_out` (a column) is true do not train."""
    held_out = id_fold() == 1 if held_out is None else held_out
    spark = docs.sparkSession
    bodies = id_and_bytes(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    total_bytes = body_bytes(bodies)
    blocks = in_blocks(bodies, total_bytes, BLOCK_BYTES)
    shards = max(32, 2 * shuffle_partitions(spark), math.ceil(total_bytes / SHARD_BYTES))

    def gather(key, table):
        bodies = table.column("body").to_pylist()
        train = [not h for h in table.column("held_out").to_pylist()]
        keys, n, words = _gathered(bodies, train)
        hashes = word_hashes(words)
        times = np.fromiter(words.values(), np.int64, len(words))
        hashes, times = np.append(hashes, np.uint64(END_WORD)), np.append(times, sum(train))
        at = np.argsort(hashes, kind="stable")
        hashes, times = hashes[at], times[at]
        by_key, by_word = shard_of(keys, shards), hashes % np.uint64(shards)
        ko, wo = np.argsort(by_key, kind="stable"), np.argsort(by_word, kind="stable")
        ke = np.searchsorted(by_key[ko], np.arange(shards + 1))
        we = np.searchsorted(by_word[wo], np.arange(shards + 1))
        out = {c: [] for c in ("keys", "counts", "words", "times")}
        used = np.nonzero((np.diff(ke) > 0) | (np.diff(we) > 0))[0].tolist()
        for s in used:
            i, j = ko[ke[s]:ke[s + 1]], wo[we[s]:we[s + 1]]
            for c, x in zip(out, (keys[i], n[i].astype("<i4"), hashes[j], times[j].astype("<i4"))):
                out[c].append(_bytes(x))
        return pa.table({"shard": pa.array(used, pa.int32()),
                         "of_block": pa.array([key[0].as_py()] * len(used), pa.int32()),
                         **{c: pa.array(v, pa.binary()) for c, v in out.items()}})

    def shard_sums(table):
        keys = [_array(x, "<u8") for x in table.column("keys").to_pylist()]
        counts = [_array(x, "<i4") for x in table.column("counts").to_pylist()]
        words = [_array(x, "<u8") for x in table.column("words").to_pylist()]
        times = [_array(x, "<i4") for x in table.column("times").to_pylist()]
        all_keys, n = sorted_counts(np.concatenate(keys), np.concatenate(counts).astype(np.int64))
        all_words, t = sorted_counts(np.concatenate(words), np.concatenate(times).astype(np.int64))
        return keys, words, all_keys, n, all_words, t

    def summit(key, table):
        """A shard's part of depth 2, by group of contexts; in group -1, of the training tokens."""
        _, _, keys, n, _, times = shard_sums(table)
        out = [(-1, np.array([0, times.sum(), (times > 0).sum(), 0], float))]
        if len(keys):
            levels, (node, total) = subtree(keys, n)
            _, zeros, ones, _, _ = levels[3]
            two = np.stack(summed(parents(node), zeros, ones, total))
            group = (two[0].astype(np.int64) >> 8) % PAIR_GROUPS
            out += [(g, two[:, group == g].ravel()) for g in np.unique(group).tolist()]
        return pa.table({"pairs": pa.array([g for g, _ in out], pa.int32()),
                         "of_shard": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "sums": pa.array([_bytes(x) for _, x in out], pa.binary())})

    def pair_sums(key, table):
        """One group's depth 2: to each shard its nodes with their weights (`two`), and
        upwards, to shard -1, the sums for depth 1; of group -1, the tokens as node -1."""
        parts = [_array(x, "<f8").reshape(4, -1) for x in table.column("sums").to_pylist()]
        if key[0].as_py() < 0:
            up, replies = [np.array([x]) for x in (-1, *np.concatenate(parts, axis=1).sum(axis=1)[1:])], []
        else:
            node, zeros, ones, below = summed(*np.concatenate(parts, axis=1))
            total, share = weigh(log_kt(zeros, ones), below)
            up = summed(parents(node.astype(np.uint64)), zeros, ones, total)
            whole = np.stack([node, zeros, ones, share])
            replies = [_bytes(whole[:, np.searchsorted(node, x[0])].ravel()) for x in parts]
        m = len(up[0])
        return pa.table({
            "to_shard": pa.array([-1] * m + table.column("of_shard").to_pylist()[:len(replies)], pa.int32()),
            "node": pa.array(up[0].astype(np.int64).tolist() + [None] * len(replies), pa.int64()),
            **{c: pa.array(x.tolist() + [None] * len(replies), pa.float64()) for c, x in zip(TOP, up[1:])},
            "two": pa.array([None] * m + replies, pa.binary())})

    def join_summits(key, table):
        """The sums of all groups as one row."""
        at = np.argsort(table.column("node").to_numpy())
        node, *sums = (table.column(c).to_numpy()[at] for c in ("node", *TOP))
        return pa.table({"top": [_bytes(np.concatenate([node.astype(float), *sums]))]})

    def answer(left, right):
        """Log probabilities and word counts for each block, in the order it sent them."""
        if not left.num_rows:
            return _answers([])
        keys, words, all_keys, n, all_words, times = shard_sums(left)
        node, zeros, ones, below = _array(right.column("top").drop_null()[0].as_py(), "<f8").reshape(4, -1)
        tokens, distinct = int(zeros[0]), int(ones[0])
        top = top_of(node[1:].astype(np.uint64), zeros[1:], ones[1:], below[1:])
        two = [_array(x, "<f8").reshape(4, -1) for x in right.column("two").drop_null().to_pylist()]
        two = np.concatenate([np.zeros((4, 0)), *two], axis=1)
        two = two[:, np.argsort(two[0])]
        top[2] = two[0].astype(np.uint64), *two[1:]
        log_p = log_probabilities(all_keys, subtree(all_keys, n)[0], top) if len(all_keys) else np.zeros(0)
        return _answers([
            (block, shard, _bytes(log_p[np.searchsorted(all_keys, k)]),
             _bytes(times[np.searchsorted(all_words, w)].astype("<i8")), tokens, distinct)
            for block, shard, k, w in zip(left.column("of_block").to_pylist(), left.column("shard").to_pylist(), keys, words)])

    def _answers(rows):
        schema = pa.schema([("to_block", pa.int32()), ("from_shard", pa.int32()), ("log_p", pa.binary()),
                            ("times", pa.binary()), ("tokens", pa.int64()), ("distinct_tokens", pa.int64())])
        return pa.table([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 6, schema)], schema=schema)

    def apply(left, right):
        bodies = left.column("body").to_pylist()
        train = [not h for h in left.column("held_out").to_pylist()]
        keys, _, words = _gathered(bodies, train)
        hashes = np.append(word_hashes(words), np.uint64(END_WORD))
        names = list(words) + [None]
        by_key, by_word = shard_of(keys, shards), np.sort(hashes) % np.uint64(shards)
        ko, wo = np.argsort(by_key, kind="stable"), np.argsort(by_word, kind="stable")
        ke = np.searchsorted(by_key[ko], np.arange(shards + 1))
        we = np.searchsorted(by_word[wo], np.arange(shards + 1))
        log_p, times = np.zeros(len(keys)), np.zeros(len(hashes), np.int64)
        for s, p, t in zip(*(right.column(c).to_pylist() for c in ("from_shard", "log_p", "times"))):
            log_p[ko[ke[s]:ke[s + 1]]] = _array(p, "<f8")
            times[wo[we[s]:we[s + 1]]] = _array(t, "<i8")
        at = np.argsort(hashes, kind="stable")
        count = dict(zip([names[i] for i in at], times.tolist()))
        total, distinct = right.column("tokens")[0].as_py(), right.column("distinct_tokens")[0].as_py()
        scores = []
        for i, j in chunks(bodies, SCAN_BYTES):
            k, owner = gram_keys(bodies[i:j])
            order = np.argsort(k)
            k = k[order]
            fresh = np.ones(len(k), bool)
            fresh[1:] = k[1:] != k[:-1]
            value = log_p[np.searchsorted(keys, k[fresh])][np.cumsum(fresh) - 1]
            scores += np.bincount(owner[order], value, j - i).tolist()
        n_tokens, n_known, base = [], [], []
        whole = math.log10(total + 0.5 * (distinct + 1))
        log_of: dict[int, float] = {}
        for body in bodies:
            c = [count[w] for w in words_of(body)]
            c.append(count[None])
            n_tokens.append(len(c))
            n_known.append(len(c) - c.count(0))
            s = 0.0
            for v in c:
                x = log_of.get(v)
                if x is None:
                    x = log_of[v] = math.log10(v + 0.5) - whole
                s += x
            base.append(s)
        return pa.table({
            "doc_id": left.column("doc_id"), "held_out": left.column("held_out"),
            "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([total] * len(bodies), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64())})

    sent = blocks.groupBy("block").applyInArrow(
        gather, "shard int, of_block int, keys binary, counts binary, words binary, times binary"
    ).repartition(shards, "shard")
    pairs = sent.groupBy("shard").applyInArrow(summit, "pairs int, of_shard int, sums binary").groupBy(
        "pairs").applyInArrow(pair_sums, "to_shard int, node long, zeros double, ones double, below double, two binary")
    # depths 0 and 1 are 257 contexts of 255 nodes at most: summed, they are one row, sent to each shard
    top = pairs.where("to_shard < 0").groupBy("node").agg(*[F.sum(c).alias(c) for c in TOP]).withColumn(
        "whole", F.lit("whole")).groupBy("whole").applyInArrow(join_summits, "top binary")
    to_all = top.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("to_shard"), "top",
                        F.lit(None).cast("binary").alias("two"))
    to_all = to_all.unionByName(pairs.where("to_shard >= 0").select("to_shard", F.lit(None).cast("binary").alias("top"), "two"))
    answers = sent.groupBy("shard").cogroup(to_all.groupBy("to_shard")).applyInArrow(
        answer, "to_block int, from_shard int, log_p binary, times binary, tokens long, distinct_tokens long")
    return blocks.groupBy("block").cogroup(answers.groupBy("to_block")).applyInArrow(
        apply, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
