"""Exact removal of repeated 100-byte strings by a distributed suffix sort.

Only some suffixes are sorted: those at anchors. A window of `width` bytes has
one anchor, the leftmost of its starts whose hashed 8-gram is smallest, at least
`core` bytes before the window's end; equal windows have it at the same place, so
windows are equal only if their anchors' contexts agree. An anchor's context is
the text all its windows cover: the suffix from the anchor, then what precedes
it, backwards. Sorted, anchors with a common core stand together, and the common
prefix of neighbours says how far their windows agree.

1. Distinguishing prefixes: blocks of documents exchange the hashes of their
   anchors' cores; an anchor whose core occurs once is in no repeat.
2. Each block sorts the contexts left into a run in which equal contexts are
   one entry (all but the first occur earlier, so their windows are removed at
   once), and sends it front-coded, cut at common splitters. A passage that a
   third of all documents share is one entry of each run.
3. A task merges the runs of its range by a loser tree that keeps, for every
   loser, its common prefix with the string that beat it: candidates with
   different known prefixes are ordered by them, and characters are compared
   only from the known prefix on. Among neighbours with a common core, windows
   are resolved by their common prefixes and suffixes.
4. Where splitters cut through one core's contexts, the windows that may equal
   one across the cut are exchanged by digest and resolved there.

Ranges hold about as many distinct contexts each, whatever the keys; blocks and
ranges grow in number with the text, and every step keeps one of them in memory.

Defined cases: a null text is empty; texts below `width` bytes lose nothing;
rows are ordered by (doc_id, hash of the text), null ids last, so that the rows of
one id need not meet; repeated rows are documents of their own; a text longer than
a block is a block of its own; further columns of any name stay out of the plan
(with `text`, they are carried along); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from weir.llm.common import body_bytes, chunks, id_and_bytes, in_blocks, released, shuffle_partitions, sorted_block

MIX = np.uint64(0x9E3779B97F4A7C15)
WIDTH, CORE = 100, 32
BLOCK_BYTES = 8 << 20
RANGE_BYTES = 16 << 20  # text per range of hashes; there are twice as many ranges of contexts
SCAN_BYTES = 1 << 20  # texts are scanned for anchors in pieces of this many bytes
SPLITTER_DOCS = 2000  # documents sampled for splitters; they only decide which task merges what
MAX_SPLITTERS = 1 << 16


# ---- anchors ----------------------------------------------------------------

def _words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position, as one number; `data` has 8 bytes to spare."""
    return np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))[at]


def _anchors_of(data: np.ndarray, n: int, width: int, core: int):
    """Anchors of one text of n bytes (`data` padded): (anchor, first and last
    window start it answers for)."""
    w = width - core + 1  # starts among which a window picks its anchor
    grams = np.ndarray((n,), "<u8", data.data, strides=(1,)) * MIX
    key = (grams >> np.uint64(33) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    # smallest key of every w consecutive starts: block minima from both sides
    full = np.full(-(-n // w) * w + w, np.uint64(2**64 - 1))
    full[:n] = key
    rows = full.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    pick = (np.minimum(right[:m], left[w - 1:w - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.nonzero(np.concatenate(([True], pick[1:] != pick[:-1])))[0]
    last = np.concatenate((first[1:], [m])) - 1
    return pick[first], first, last


def anchors(bodies: list[bytes], width: int = WIDTH, core: int = CORE):
    """(row, anchor, first start, last start) of all texts, scanned in pieces of
    bounded size. A piece's own starts are those whose window begins in it; an
    anchor may be met by two pieces, each with its own starts."""
    out = []
    for row, body in enumerate(bodies):
        n = len(body)
        if n < width:
            continue
        for base in range(0, n - width + 1, SCAN_BYTES):
            part = body[base:base + SCAN_BYTES + width - 1]
            data = np.frombuffer(part + b"\0" * 8, np.uint8)
            p, a, b = _anchors_of(data, len(part), width, core)
            out.append(np.stack([np.full(len(p), row), p + base, a + base, b + base]))
    return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)


def _gather(bodies: list[bytes]):
    """All bodies as one padded array, and each body's place in it."""
    at = np.concatenate(([0], np.cumsum([len(b) for b in bodies]))).astype(np.int64)
    return np.frombuffer(b"".join(bodies) + b"\0" * 256, np.uint8), at


def core_hashes(data: np.ndarray, at: np.ndarray, core: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for k in range(0, core, 8):
        h = (h ^ _words_at(data, at + k)) * MIX
        h ^= h >> np.uint64(29)
    return h


def contexts(data, lo, p, a, b, width: int, core: int) -> np.ndarray:
    """One row per anchor: the suffix from the anchor to its last window's end,
    padded to `width`; then what precedes it back to its first window's start,
    padded; then both lengths, each plus one."""
    left = width - core
    suffix, before = b + width - p, p - a
    out = np.zeros((len(p), width + left + 2), np.uint8)
    k = np.arange(width)
    for i in range(0, len(p), 1 << 15):
        s = slice(i, i + (1 << 15))
        out[s, :width] = np.where(k < suffix[s, None], data[(lo + p)[s, None] + k], 0)
        j = np.arange(left)
        at = np.maximum((lo + p)[s, None] - 1 - j, 0)
        out[s, width:width + left] = np.where(j < before[s, None], data[at], 0)
    out[:, -2], out[:, -1] = suffix + 1, before + 1
    return out


def _as_strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the row above (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    for i in range(1, len(rows), 1 << 15):
        s = rows[i:i + (1 << 15)]
        differ = s != rows[i - 1:i - 1 + len(s)]
        out[i:i + len(s)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


# ---- runs -------------------------------------------------------------------

def front_code(rows: np.ndarray) -> tuple[bytes, bytes]:
    """Common prefix lengths with the row above, and the remaining tails."""
    lcp = common_prefixes(rows)
    tails = rows[np.arange(rows.shape[1]) >= lcp[:, None]]
    return lcp.astype(np.uint8).tobytes(), tails.tobytes()


def front_decode(lcp: bytes, tails: bytes, width: int) -> tuple[list[int], list[bytes]]:
    known, out, at, last = list(lcp), [], 0, b""
    for h in known:
        end = at + width - h
        last = last[:h] + tails[at:end]
        out.append(last)
        at = end
    return known, out


def merge_runs(runs: list[tuple[list[int], list[bytes]]]):
    """Merge sorted runs (each with its strings' common prefixes with the one
    before) by a loser tree. Returns, in order, the run and index of every string
    and its common prefix with the string before it.

    A tree node holds the loser of its match and the loser's common prefix with
    the winner. All strings in play are no smaller than the last one output, and
    their stored prefixes are with it or with one it equals that far: the longer
    prefix is the smaller string, and only equal prefixes need characters, from
    there on."""
    k = max(1, len(runs))
    size = 1 << (k - 1).bit_length()
    at = [0] * size
    strings = [r[1] for r in runs] + [[] for _ in range(size - k)]
    prefixes = [r[0] for r in runs] + [[] for _ in range(size - k)]
    losers, known = [-1] * size, [0] * size  # by node: run, prefix
    width = next((len(s[0]) for s in strings if s), 0)

    def match(x: int, y: int, h: int) -> tuple[int, int, int]:
        """Winner, loser and their common prefix, both runs' heads sharing h bytes."""
        if x < 0 or y < 0:
            return (y, x, 0) if x < 0 else (x, y, 0)
        a, b = strings[x][at[x]], strings[y][at[y]]
        ta, tb = a[h:], b[h:]
        if ta == tb:
            return (x, y, width) if x < y else (y, x, width)
        differ = int.from_bytes(ta, "big") ^ int.from_bytes(tb, "big")
        m = width - (differ.bit_length() + 7) // 8
        return (x, y, m) if ta < tb else (y, x, m)

    def build(node: int) -> int:
        if node >= size:
            run = node - size
            return run if strings[run] else -1
        winner, loser, h = match(build(2 * node), build(2 * node + 1), 0)
        losers[node], known[node] = loser, h
        return winner

    winner = build(1) if size > 1 else (0 if strings[0] else -1)
    h = 0
    out_run, out_at, out_lcp = [], [], []
    while winner >= 0:
        i = at[winner]
        out_run.append(winner)
        out_at.append(i)
        out_lcp.append(h)
        at[winner] = i = i + 1
        node = (winner + size) >> 1
        if i < len(strings[winner]):
            run, h = winner, prefixes[winner][i]
        else:
            run, h = -1, -1
        while node:
            other = losers[node]
            if other >= 0:
                ho = known[node]
                if ho > h:  # also where the candidate's run is at its end
                    losers[node], known[node] = run, max(h, 0)
                    run, h = other, ho
                elif ho == h:
                    run, losers[node], known[node] = match(run, other, h)
            node >>= 1
        winner = run
    return np.array(out_run, np.int64), np.array(out_at, np.int64), np.array(out_lcp, np.int64)


# ---- windows ----------------------------------------------------------------

def resolve(rows: np.ndarray, lcp: np.ndarray, order: np.ndarray, cross: np.ndarray, width: int, core: int):
    """For distinct sorted contexts and each number o of bytes before the anchor:
    the contexts whose window an earlier one also has, and the first holder of
    each window. `order`: each context's place in text order; `cross`: the prefix
    it shares with contexts beyond its range."""
    m, left = len(rows), width - core
    suffix, before = rows[:, -2].astype(np.int64) - 1, rows[:, -1].astype(np.int64) - 1
    back = np.ascontiguousarray(rows[:, width:width + left])
    by_back = np.argsort(_as_strings(np.concatenate([back, np.full((m, 1), 1, np.uint8)], axis=1)), kind="stable")
    back_lcp = common_prefixes(back[by_back])
    early = np.argsort(order, kind="stable")
    # contexts none of whose neighbours shares their core are in no repeat
    alone = np.concatenate((lcp[1:] < core, [True])) & (lcp < core) & (cross < core)
    for o in range(left + 1):
        valid = (before >= o) & (suffix >= width - o) & ~alone
        if not valid.any():
            continue
        right_id = np.cumsum(lcp < width - o)
        left_id = np.empty(m, np.int64)
        left_id[by_back] = np.cumsum(back_lcp < o) if o else 0
        held = early[valid[early]]
        key = right_id[held] * (m + 1) + left_id[held]
        _, first = np.unique(key, return_index=True)
        is_first = np.zeros(len(held), bool)
        is_first[first] = True
        yield o, held[~is_first], held[is_first]


def intervals(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of [start, end) by row, sorted."""
    if not len(row):
        return row, start, end
    at = np.lexsort((start, row))
    row, start, end = row[at], start[at], end[at]
    reach = end.copy()
    # running end within a row: rows are ordered, so shift each row above all before it
    lift = row * (int(end.max()) + 1)
    reach = np.maximum.accumulate(reach + lift)
    fresh = np.concatenate(([True], start[1:] + lift[1:] > reach[:-1]))
    first = np.nonzero(fresh)[0]
    last = np.concatenate((first[1:], [len(row)])) - 1
    return row[first], start[first], reach[last] - lift[first]


# ---- the job ----------------------------------------------------------------

def _splitters(docs: DataFrame, ranges: int, width: int, core: int) -> list[bytes]:
    """Contexts that cut the sorted order into `ranges` parts, from a bounded
    sample of documents. They decide only where strings are merged."""
    n = docs.count()
    keep = max(1, n // SPLITTER_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(keep)) == 0)

    def take(batches):
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for i, j in chunks(bodies, SCAN_BYTES):
                row, p, a, b = anchors(bodies[i:j], width, core)
                data, lo = _gather(bodies[i:j])
                rare = core_hashes(data, lo[row] + p, core) >> np.uint64(8) != 0
                step = max(1, len(p) // 4000)  # a very long text gives no more than a few thousand
                s = np.nonzero(rare)[0][::step]
                rows = contexts(data, lo[row[s]], p[s], a[s], b[s], width, core)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], names=["c"])

    drawn = sample.mapInArrow(take, "c binary").distinct()
    # distinct contexts, those with a common core counted twice: they are what is merged
    spread = drawn.withColumn("d", F.xxhash64("c")).orderBy("d").limit(min(MAX_SPLITTERS, 64 * ranges)).select("c")
    found = sorted(bytes(r.c) for r in spread.collect())
    weight = [2 if (i and x[:core] == found[i - 1][:core]) else 1 for i, x in enumerate(found)]
    total, out, run = sum(weight), [], 0
    for x, w in zip(found, weight):
        if run >= total * (len(out) + 1) / ranges and len(out) < ranges - 1:
            out.append(x)
        run += w
    return out


def _ids(table) -> np.ndarray:
    """Row ids (a null id sorts last) and hashes of the texts in block order: rows
    of (id, tie), the order of documents across blocks."""
    ids, _, order = sorted_block(table)
    return np.stack([np.array([2**63 - 1 if i is None else i for i in ids], np.int64),
                     table.column("tie").to_numpy()[order]])


def _pack(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x))


def _unpack(x: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(x)


def _triples(row, start, end) -> bytes:
    return _pack(np.stack([row, start, end], axis=1).astype("<i8"))


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


HASHES = pa.schema([("part", pa.int32()), ("at_block", pa.int32()), ("hashes", pa.binary())])
RUNS = pa.schema([("range", pa.int32()), ("of_block", pa.int32()), ("prefixes", pa.binary()),
                  ("tails", pa.binary()), ("places", pa.binary())])
SAID = pa.schema([("to", pa.int32()), ("of_block", pa.int32()), ("windows", pa.bool_()), ("data", pa.binary())])


def spans_by_block(blocks: DataFrame, cuts: list[bytes], parts: int, width: int, core: int) -> DataFrame:
    """(of_block, data): what to remove, as int64 triples (row in block, start, end)."""
    row_bytes = width + (width - core) + 2
    cut_keys = np.array(cuts, f"S{row_bytes}")
    bounds = np.array([k * (2**64 // parts) for k in range(1, parts)], np.uint64)

    def hashes(key, table):
        _, bodies, _ = sorted_block(table)
        found = [np.zeros(0, np.uint64)]
        for i, j in chunks(bodies, SCAN_BYTES):
            row, p, _, _ = anchors(bodies[i:j], width, core)
            data, lo = _gather(bodies[i:j])
            found.append(np.unique(core_hashes(data, lo[row] + p, core)))
        h = np.unique(np.concatenate(found))
        split = np.split(h, np.searchsorted(h, bounds))
        return _table(HASHES, [(k, key[0].as_py(), x.tobytes()) for k, x in enumerate(split) if len(x)])

    def shared(key, table):
        """Of one range of hashes, for each block, those other blocks have too."""
        blobs = [np.frombuffer(x, "<u8") for x in table.column("hashes").to_pylist()]
        h, n = np.unique(np.concatenate(blobs), return_counts=True)
        twice = h[n > 1]
        out = [x[np.isin(x, twice, assume_unique=True)].tobytes() for x in blobs]
        return pa.table({"to_block": table.column("at_block"), "hashes": pa.array(out, pa.binary())})

    def runs(left, right):
        """A block's sorted run, cut by range and front-coded; ranges below zero
        carry what the block decides by itself."""
        if not left.num_rows:
            return _table(RUNS, [])
        block = left.column("block")[0].as_py()
        _, bodies, _ = sorted_block(left)
        found, own = [np.zeros((4, 0), np.int64)], [np.zeros(0, np.uint64)]
        for i, j in chunks(bodies, SCAN_BYTES):
            a = anchors(bodies[i:j], width, core)
            data, lo = _gather(bodies[i:j])
            own.append(core_hashes(data, lo[a[0]] + a[1], core))
            a[0] += i
            found.append(a)
        found, own = np.concatenate(found, axis=1), np.concatenate(own)
        h, n = np.unique(own, return_counts=True)
        shared_here = [np.frombuffer(x, "<u8") for x in right.column("hashes").to_pylist()]
        keep = np.isin(own, np.concatenate([h[n > 1], *shared_here]))
        row, p, a, b = found[:, keep]
        del found, own, h, n, shared_here, keep
        data, lo = _gather(bodies)
        keys = _as_strings(contexts(data, lo[row], p, a, b, width, core))
        at = np.lexsort((a, row, keys))  # equal contexts in text order
        keys, row, p, a, b = keys[at], row[at], p[at], a[at], b[at]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        spans = intervals(row[~fresh], a[~fresh], b[~fresh] + width)
        out = [(-1 - block % parts, block, b"", b"", _triples(*spans))] if len(spans[0]) else []
        keys, row, p = keys[fresh], row[fresh], p[fresh]
        ids = _ids(left)
        edges = [0, *np.searchsorted(keys, cut_keys, side="left").tolist(), len(keys)]
        for k, (i, j) in enumerate(zip(edges, edges[1:])):
            if j > i:
                lcp, tails = front_code(keys[i:j].view(np.uint8).reshape(-1, row_bytes))
                places = np.stack([*ids[:, row[i:j]], row[i:j], p[i:j]], axis=1).astype("<i8")
                out.append((k, block, lcp, _pack(np.frombuffer(tails, np.uint8)), _pack(places)))
        return _table(RUNS, out)

    def merge(key, table):
        """Merge a range's runs; what its windows decide, and what the next range may."""
        rng = key[0].as_py()
        if rng < 0:
            return _table(SAID, [(-1 - b, b, False, x) for b, x in zip(
                table.column("of_block").to_pylist(), table.column("places").to_pylist())])
        lists = [front_decode(x, _unpack(t), row_bytes) for x, t in zip(
            table.column("prefixes").to_pylist(), table.column("tails").to_pylist())]
        block_of = np.array(table.column("of_block").to_pylist(), np.int64)
        places = [np.frombuffer(_unpack(x), "<i8").reshape(-1, 4) for x in table.column("places").to_pylist()]
        run, index, lcp = merge_runs(lists)
        first_of = np.cumsum([0, *map(len, places)])[:-1]
        ids, tie, row, p = np.concatenate(places)[first_of[run] + index].T
        block = block_of[run]
        text = np.empty(len(ids), np.int64)
        text[np.lexsort((p, row, block, tie, ids))] = np.arange(len(ids))  # place in text order
        fresh = lcp < row_bytes
        fresh[:1] = True
        group = np.cumsum(fresh) - 1
        earliest = np.full(int(fresh.sum()), len(ids), np.int64)
        np.minimum.at(earliest, group, text)
        rows = np.frombuffer(b"".join([lists[r][1][i] for r, i in zip(run[fresh], index[fresh])]),
                             np.uint8).reshape(-1, row_bytes)
        suffix, before = rows[group, -2].astype(np.int64) - 1, rows[group, -1].astype(np.int64) - 1
        later = text != earliest[group]
        out_block, out_row = [block[later]], [row[later]]
        out_start, out_end = [(p - before)[later], ], [(p + suffix)[later]]
        # the earliest of each distinct context, in sorted order
        one = np.nonzero(~later)[0]
        lcp1 = lcp[fresh].copy()
        lcp1[:1] = 0
        cross = np.zeros(len(rows), np.int64)  # prefix shared with the range's ends
        for c in cut_keys[max(0, rng - 1):rng + 1]:
            differ = rows != np.frombuffer(c.ljust(row_bytes, b"\0"), np.uint8)
            cross = np.maximum(cross, np.where(differ.any(axis=1), differ.argmax(axis=1), row_bytes))
        doubt = []
        for o, again, holders in resolve(rows, lcp1, text[one], cross, width, core):
            i = one[again]
            out_block.append(block[i])
            out_row.append(row[i])
            out_start.append(p[i] - o)
            out_end.append(p[i] - o + width)
            doubt.append((o, holders[cross[holders] >= width - o]))
        said = []
        block_all, row_all = np.concatenate(out_block), np.concatenate(out_row)
        start_all, end_all = np.concatenate(out_start), np.concatenate(out_end)
        for b in np.unique(block_all).tolist():
            m = block_all == b
            said.append((-1 - b, b, False, _triples(*intervals(row_all[m], start_all[m], end_all[m]))))
        said += _doubtful(rows, doubt, one, block, (ids, tie, row), p, parts, width)
        return _table(SAID, said)

    def settle(key, table):
        """Windows whose equals may be in other ranges: all but the earliest go."""
        if key[0].as_py() < 0:
            return pa.table({"to_block": table.column("of_block"), "data": table.column("data")})
        parts_of = [np.frombuffer(_unpack(x), "<i8").reshape(-1, 6) for x in table.column("data").to_pylist()]
        block = np.repeat(np.array(table.column("of_block").to_pylist(), np.int64), [len(x) for x in parts_of])
        w = np.concatenate(parts_of)
        at = np.lexsort((w[:, 5], w[:, 4], block, w[:, 3], w[:, 2], w[:, 1], w[:, 0]))
        w, block = w[at], block[at]
        again = np.zeros(len(w), bool)
        again[1:] = (w[1:, 0] == w[:-1, 0]) & (w[1:, 1] == w[:-1, 1])
        w, block = w[again], block[again]
        out = [(b, _triples(*intervals(w[m, 4], w[m, 5], w[m, 5] + width)))
               for b in np.unique(block).tolist() for m in (block == b,)]
        return pa.table({"to_block": pa.array([o[0] for o in out], pa.int32()),
                         "data": pa.array([o[1] for o in out], pa.binary())})

    hashed = blocks.groupBy("block").applyInArrow(
        lambda key, table: released(hashes, key, table), "part int, at_block int, hashes binary")
    common = hashed.groupBy("part").applyInArrow(
        lambda key, table: released(shared, key, table), "to_block int, hashes binary")
    run_rows = blocks.groupBy("block").cogroup(common.groupBy("to_block")).applyInArrow(
        lambda left, right: released(runs, left, right),
        "range int, of_block int, prefixes binary, tails binary, places binary")
    said = run_rows.groupBy("range").applyInArrow(
        lambda key, table: released(merge, key, table), "to int, of_block int, windows boolean, data binary")
    return said.groupBy("to").applyInArrow(
        lambda key, table: released(settle, key, table), "to_block int, data binary")


def _doubtful(rows, doubt, one, block, at_row, p, parts, width):
    """Messages with the windows of `doubt`: digest (two numbers), id, tie, row, start."""
    import xxhash

    got = {}
    digest = xxhash.xxh3_128_digest
    for o, held in doubt:
        if not len(held):
            continue
        back = rows[held, width:width + o][:, ::-1]
        strings = np.ascontiguousarray(np.concatenate([back, rows[held, :width - o]], axis=1)).tobytes()
        d = b"".join([digest(strings[k:k + width]) for k in range(0, len(strings), width)])
        i = one[held]
        record = np.concatenate([np.frombuffer(d, "<i8").reshape(-1, 2),
                                 np.stack([*(x[i] for x in at_row), p[i] - o], axis=1)], axis=1)
        to = (record[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)
        where = to << 32 | block[i]
        at = np.argsort(where, kind="stable")
        keys, first = np.unique(where[at], return_index=True)
        for k, part in zip(keys.tolist(), np.split(record[at], first[1:])):
            got.setdefault(k, []).append(part)
    return [(k >> 32, k & 0xFFFFFFFF, True, _pack(np.concatenate(x).astype("<i8"))) for k, x in got.items()]


def remove_repeats(docs: DataFrame, width: int = WIDTH, core: int = CORE, text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with `text`,
    instead the columns of `docs`, `text` holding what is left (bytes that no
    longer form a character are dropped) and `n_chars` its characters."""
    spark = docs.sparkSession
    if text:
        rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
        body = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"),
                           F.struct(*[c for c, n in zip(rest, docs.columns) if n != "text"]).alias("rest"),
                           F.col("text").isNull().alias("is_null"))
    else:
        body = id_and_bytes(docs)
    total = body_bytes(body)
    blocks = in_blocks(body, total, BLOCK_BYTES)
    parts = max(shuffle_partitions(spark), total // RANGE_BYTES)
    cuts = _splitters(id_and_bytes(docs), max(32, 2 * parts), width, core)
    spans = spans_by_block(blocks, cuts, parts, width, core)

    def apply(left, right):
        ids, bodies, order = sorted_block(left)
        triples = [np.frombuffer(_unpack(x), "<i8").reshape(-1, 3) for x in right.column("data").to_pylist()]
        row, start, end = intervals(*np.concatenate(triples).T) if triples else (np.zeros(0, np.int64),) * 3
        at = np.searchsorted(row, np.arange(len(ids) + 1))
        kept, removed, n_spans = [], [], []
        for k, body_ in enumerate(bodies):
            i, j = at[k], at[k + 1]
            if i == j:
                kept.append(body_)
            else:
                cut = [0, *np.stack([start[i:j], end[i:j]], axis=1).ravel().tolist(), len(body_)]
                kept.append(b"".join([body_[x:y] for x, y in zip(cut[::2], cut[1::2])]))
            removed.append(len(body_) - len(kept[-1]))
            n_spans.append(int(j - i))
        if text:
            left = left.take(pa.array(order))
            texts = [None if null else x.decode("utf-8", "ignore")
                     for x, null in zip(kept, left.column("is_null").to_pylist())]
            return pa.table({"rest": left.column("rest"), "new_text": pa.array(texts, pa.string()),
                             "removed": pa.array(removed, pa.int64())})
        return pa.table({
            "doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(x) for x in bodies], pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())})

    pair = blocks.groupBy("block").cogroup(spans.groupBy("to_block"))
    if not text:
        return pair.applyInArrow(
            lambda left, right: released(apply, left, right),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    out = pair.applyInArrow(lambda left, right: released(apply, left, right), StructType([
        blocks.schema["rest"], StructField("new_text", StringType()), StructField("removed", LongType())]))
    columns = []
    for i, name in enumerate(docs.columns):
        if name == "text":
            columns.append(F.col("new_text").alias("text"))
        elif name == "n_chars":
            columns.append(F.when(F.col("removed") > 0, F.length("new_text").cast(docs.schema[i].dataType))
                           .otherwise(F.col(f"rest.c{i}")).alias(name))
        else:
            columns.append(F.col(f"rest.c{i}").alias(name))
    return out.select(*columns)
