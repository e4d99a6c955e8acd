"""Best-fit packing by a configuration linear program.

Pieces are counted by length (a histogram of at most `capacity` rows, the only
thing that reaches the driver). The program "as few configurations as cover
every length's count" is solved by multiplicative weights: every length has a
price; a round fills sequences with configurations whose price is near the
greatest, found by one knapsack dynamic program over the capacity for all lengths
at once, and then multiplies each length's price by how far the round covered it:
down if covered twice, up if not. Prices over the greatest configuration price are
feasible for the dual program, so every round also bounds the optimum from below.
The fractional solution is rounded to whole configurations, fullest first, the
program is solved again for what is left, and the last few pieces are placed best
fit. Pieces then find their sequence by their rank within their length, counted in
two steps so that a length that holds a third of all pieces is not ranked by one
task.

Defined cases: a null text is empty and packs as the end id alone; a null doc_id
is kept; repeated rows are packed each; a text of any length is cut into pieces;
further columns of any name stay out of the plan; an empty table gives an empty
result.
"""

from __future__ import annotations

import bisect
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from weir.llm.bpe import worker_encoder
from weir.llm.common import give_back, id_and_bytes
from weir.session import scratch_path

Plan = list[tuple[tuple[int, ...], int]]  # (lengths in one sequence, how many such sequences)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest total value that fits each space, and the last piece taken
    for it (-1: none, the space is one less)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fits[c]
        best[c] = best[c - 1]
        if k:
            gain = values[:k] + best[c - sizes[:k]]
            i = int(gain.argmax())
            if gain[i] > best[c]:
                best[c], pick[c] = gain[i], i
    return best, pick


def configuration(first: int, pick: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[int, int]:
    """The best configuration that holds length `first`: indices of lengths -> copies."""
    out, c = {first: 1}, capacity - int(sizes[first])
    while c > 0:
        i = int(pick[c])
        if i < 0:
            c -= 1
            continue
        out[i] = out.get(i, 0) + 1
        c -= int(sizes[i])
    return out


def solve(counts: dict[int, int], capacity: int, budget: int, rounds: int = 60, rate: float = 0.3, near: float = 0.1,
          width: float = 2.0) -> tuple[dict[tuple, float], float]:
    """Configurations of the fractional solution with how often each is used (the
    rounds' sum, scaled to cover the least covered length once; their mean, where
    one is not covered at all), and a lower bound of the program's optimum. A round uses
    at most `budget` sequences, configurations within `near` of the greatest price,
    and covers no length more than `width` times."""
    sizes = np.array(sorted(counts), np.int64)
    need = np.array([counts[int(s)] for s in sizes], float)
    weight = sizes / capacity
    used: dict[tuple, float] = {}
    bound, cover = 0.0, np.zeros(len(sizes))
    for t in range(1, rounds + 1):
        best, pick = knapsack(weight, sizes, capacity)
        bound = max(bound, float(need @ weight) / best[capacity])
        value = weight + best[capacity - sizes]
        covered, spent = np.zeros(len(sizes)), 0.0
        for i in np.argsort(-value, kind="stable").tolist():
            if spent >= budget or value[i] < (1 - near) * best[capacity]:
                break
            if covered[i] >= 1:
                continue
            config = configuration(i, pick, sizes, capacity)
            at, copies = np.fromiter(config, int), np.fromiter(config.values(), float)
            room = (width - covered[at]).clip(0) * need[at] / copies
            step = min(room.min(), (1 - covered[i]) * need[i] / config[i], budget - spent)
            if step > 0:
                key = tuple(sorted(((int(sizes[j]), a) for j, a in config.items()), reverse=True))
                used[key] = used.get(key, 0.0) + step
                covered[at] += copies * step / need[at]
                spent += step
        cover += covered
        weight = weight * np.exp(rate / math.sqrt(t) * (1 - covered))
        weight /= weight.max()
    scale = float(cover.min()) or float(rounds)
    return {key: x / scale for key, x in used.items()}, bound


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over the histogram: bins of like content are one entry
    with a count, so the work follows the lengths, not the pieces."""
    groups: dict[int, list[list]] = {}  # free space -> [content, bins]
    spaces: list[int] = []

    def put(free: int, content: tuple[int, ...], n: int) -> None:
        if free not in groups:
            groups[free] = []
            bisect.insort(spaces, free)
        groups[free].append([content, n])

    for size in sorted(counts, reverse=True):
        b = counts[size]
        while b:
            i = bisect.bisect_left(spaces, size)
            if i == len(spaces):
                per = capacity // size
                full, rest = divmod(b, per)
                if full:
                    put(capacity - per * size, (size,) * per, full)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            free = spaces[i]
            content, n = groups[free].pop()
            if not groups[free]:
                del groups[free]
                spaces.pop(i)
            fit = free // size
            m = min(n, b // fit)
            if m:
                put(free - fit * size, content + (size,) * fit, m)
                b -= m * fit
            else:
                m, fit = 1, b
                put(free - fit * size, content + (size,) * fit, 1)
                b = 0
            if n > m:
                put(free, content, n - m)
    return [(tuple(content), n) for found in groups.values() for content, n in found]


def rounded(solution: dict[tuple, float], left: dict[int, int]) -> Plan:
    """Whole configurations, fullest and most used first, each at most the
    solution's use rounded up and only of pieces that are left; `left` is updated."""
    plan = []
    for config, x in sorted(solution.items(), key=lambda c: (-sum(s * a for s, a in c[0]), -c[1], c[0])):
        n = min([math.ceil(x), *(left[s] // a for s, a in config)])
        if n:
            plan.append((tuple(s for s, a in config for _ in range(a)), n))
            for s, a in config:
                left[s] -= a * n
    return plan


def sequences(plan: Plan) -> int:
    return sum(n for _, n in plan)


def by_program(counts: dict[int, int], capacity: int, near: float, budget: int) -> tuple[Plan, dict[int, int], float]:
    """The program's whole configurations, the pieces it leaves, and the lower bound."""
    left, plan, bound = dict(counts), [], 0.0
    for rounds in (60, *(25,) * 6):  # the whole histogram, then what is left
        solution, low = solve(left, capacity, budget, rounds, near=near)
        bound = bound or low
        before = sum(left.values())
        plan += rounded(solution, left)
        left = {s: n for s, n in left.items() if n}
        if sum(left.values()) > 0.9 * before or len(left) < 2:
            break
        budget = sequences(best_fit(left, capacity))
    return plan, left, bound


def pack_plan(counts: dict[int, int], capacity: int, gap: float = 0.005) -> Plan:
    """Sequences for all pieces of a histogram (length -> pieces): the program's
    configurations, then best fit for what it leaves. Where that is further than
    `gap` above the program's lower bound, the program is solved once more with
    every length's best configuration, however low its price, and the plan of
    fewer sequences stays, as does best fit alone if it has fewer still."""
    counts = {s: n for s, n in counts.items() if n}
    alone: Plan = [((capacity,), counts.pop(capacity))] if capacity in counts else []
    if not counts:
        return alone
    plans = [best_fit(counts, capacity)]
    for near in (0.1, 1.0):
        plan, left, bound = by_program(counts, capacity, near, sequences(plans[0]))
        plans.insert(0, plan + best_fit(left, capacity))
        if sequences(plans[0]) <= math.ceil(bound * (1 + gap)):
            break
    return alone + min(plans, key=sequences)


def slot_table(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, copies in a sequence, first sequence, offset of
    the first copy), sorted: where the pieces of each length go by rank."""
    rows, ranks, first = [], {}, 0
    for content, n in plan:
        offset = 0
        for size in sorted(set(content), reverse=True):
            a = content.count(size)
            rows.append((size, ranks.get(size, 0), a, first, offset))
            ranks[size] = ranks.get(size, 0) + a * n
            offset += a * size
        first += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


SLICE_ROWS = 1_000  # documents whose pieces are made at once
PLACES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and with `ids` the ids themselves) of
    every piece: a document's ids and the end id, cut only where they exceed `capacity`."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encoder = worker_encoder(tokenizer)
        # in slices: a slice's ids stand in memory several times until they are sent
        for b in (x.slice(i, SLICE_ROWS) for x in batches for i in range(0, max(1, x.num_rows), SLICE_ROWS)):
            out, held = [], []
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                whole = encoder.encode(body.decode("utf-8", "replace")) + end
                if ids:
                    held.append(whole)
                for k in range(0, len(whole), 4 * capacity):
                    part = whole[k:k + 4 * capacity]
                    out.append((doc_id, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:  # a document's pieces follow one another, so its ids need no cut
                ends = np.cumsum([0, *columns[3]], dtype=np.int32)
                arrays.append(pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(held), "<i4")))
            yield pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * ids)
        give_back()

    return id_and_bytes(docs).mapInArrow(cut, PLACES + ", ids array<int>" * ids)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, ids: bool = False) -> DataFrame:
    """Every piece with its `sequence_id` and `offset`, and with `ids` its ids: a
    sequence is its pieces' ids joined by offset, with no text tokenized again."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    # the histogram and the placement both read the pieces: written once; only the placement reads their ids
    pieces(docs, tokenizer_path, capacity, end_id, ids).write.mode("overwrite").parquet(path)
    cut = spark.read.parquet(path)
    # a length's pieces are ranked in parts, so that a frequent length is many groups
    parts = max(1, math.ceil((cut.count() or 1) / 20_000))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    tally = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slot_table(pack_plan(histogram, capacity))  # bounded by the capacity, not by the pieces
    before = tally.select(
        F.col("length").alias("l"), F.col("part").alias("p"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(within) - 1).join(
        before, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p"))
    ).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"),
             *["ids"] * ids)
    size_of, rank_of = slots[:, 0], slots[:, 1]
    start_of = {int(s): i for i, s in reversed(list(enumerate(size_of)))}

    def place(batches):
        bounds = np.array([start_of.get(s, 0) for s in range(capacity + 2)])
        ends = np.array([start_of.get(s, -1) + int((size_of == s).sum()) for s in range(capacity + 2)])
        width = int(rank_of.max(initial=0)) + 1
        keys = size_of * width + rank_of
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(keys, length * width + np.minimum(rank, width - 1), side="right") - 1
            at = np.clip(at, bounds[length], ends[length] - 1)
            row = slots[at]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(row[:, 3] + k // row[:, 2]),
                 pa.array(row[:, 4] + k % row[:, 2] * length), *b.columns[6:]],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * ids)

    return ranked.mapInArrow(place, PLACES + ", sequence_id long, offset long" + ", ids array<int>" * ids)
