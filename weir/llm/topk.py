"""Exact top-k inner products by no-random-access aggregation.

Candidates are dealt into blocks; within a block every dimension is a list of
the block's vectors sorted by that component. A query reads the lists slice by
slice, each from the end where its own component makes the product largest, and
takes next the slice that lowers the lists' frontier most. Every entry read is
added to its vector's known score; what is not read of a vector bounds it from
below (unread dimensions at their worst value) and from above (unread dimensions
at the lists' frontier). A vector whose upper bound is below the k-th lower bound,
or below a score that k candidates are known to reach, is an outsider. Reading
stops when the vectors left cost less to resolve by their exact scores than the
next slices to read.

The known score (the query's floor) is the k-th best of a bounded draw of all
candidates, found the same way before and carried with the query, so that every
block starts from it. Block results are merged by rank: the top k of the table
are among the top k of its blocks.

Vectors of different lengths are not compared. Ties go to the smaller id, and a
query's own id is no candidate. Vectors null or with null or non-finite
components, and rows without an id, take no part; rows repeated under one id are
candidates each; queries repeated with an equal vector are asked once. Scores
beyond 64 bits stay at the nearest 64-bit value. Further columns of any name stay
out of the plan; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from weir.llm.vectors import finite_vectors, matrix

BLOCK_ROWS = 8_192
QUERY_ROWS = 8_192
FLOOR_ROWS = 8_192  # drawn candidates whose k-th best score a query starts from
SLICES = 16  # of a list
CHECKS = (0.5, 0.6, 0.7, 0.85, 1.0)  # shares of all entries after which bounds are compared
LONG = 2**63 - 1


class SortedLists:
    """A block's lists: for each dimension its values in order, whose they are, and every vector's place."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.n, self.d = x.shape
        self.owner = np.argsort(self.x.T, axis=1, kind="stable")
        self.value = np.take_along_axis(self.x.T, self.owner, axis=1).astype(float)
        self.place = np.empty((self.d, self.n), np.uint16 if self.n < 1 << 16 else np.uint32)
        np.put_along_axis(self.place, self.owner, np.arange(self.n, dtype=self.place.dtype)[None, :], axis=1)
        self.largest = np.abs(self.value).max(axis=1, initial=0)

    def top(self, query_id: int, q: np.ndarray, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and exact scores of the query's k best, best first (fewer, where
        fewer reach the floor), and the list entries read."""
        largest = float(np.abs(q.astype(float)) @ self.largest) if self.n else 0.0
        held, read = np.nonzero(self.ids != query_id)[0], 0
        if largest < 2**52 and self.n > 4 * k:  # beyond, doubles would not bound exactly: resolve everything
            held, read = self._may_qualify(q.astype(float), k, held, -math.inf if floor is None else floor)
        if largest < 2**62:
            score = self.x[held] @ q
        else:
            exact = [sum(int(a) * int(b) for a, b in zip(self.x[i], q)) for i in held]
            score = np.array([max(-LONG - 1, min(LONG, s)) for s in exact], np.int64)
        best = np.lexsort((self.ids[held], -score.astype(object) if largest >= 2**62 else -score))[:k]
        if floor is not None:
            best = best[score[best] >= floor]
        return self.ids[held][best], score[best], read

    def _may_qualify(self, q: np.ndarray, k: int, left: np.ndarray, floor: float) -> tuple[np.ndarray, int]:
        n, d = self.n, self.d
        cuts = np.linspace(0, n, min(SLICES, n) + 1).astype(int)
        down = q >= 0  # read from the largest value on
        ends = np.where(down[:, None], n - 1 - np.maximum(cuts - 1, 0), np.maximum(cuts - 1, 0))
        frontier = q[:, None] * np.take_along_axis(self.value, ends, axis=1)  # after 0, 1, 2, ... slices
        # slices in the order of what they take off the bound, those of a list one after the other
        gain = np.minimum.accumulate(frontier[:, :-1] - frontier[:, 1:], axis=1)
        turn = np.argsort(-gain, axis=None, kind="stable") // gain.shape[1]
        worst = frontier[:, -1]
        known, taken, read = np.zeros(n), np.zeros(d, np.int64), 0
        for share in CHECKS:
            upto = np.bincount(turn[:round(share * len(turn))], minlength=d)
            for j in np.nonzero(upto > taken)[0]:
                a, b = cuts[taken[j]], cuts[upto[j]]
                at = slice(n - b, n - a) if down[j] else slice(a, b)
                known[self.owner[j, at]] += q[j] * self.value[j, at]
                read += b - a
            taken = upto
            now, depth = frontier[np.arange(d), taken], cuts[taken]
            place = self.place if len(left) > n // 2 else self.place[:, left]
            first = np.where(down, n - depth, 0).astype(place.dtype)  # unsigned: places before it wrap around
            of_seen = np.stack([worst, now]) @ (place - first[:, None] < depth[:, None].astype(place.dtype))
            of_seen = of_seen[:, left] if len(left) > n // 2 else of_seen
            lower = known[left] + (worst.sum() - of_seen[0])
            upper = known[left] + (now.sum() - of_seen[1])
            bar = max(floor, np.partition(lower, len(lower) - k)[len(lower) - k]) if len(lower) > k else floor
            left = left[upper >= bar]
            if len(left) <= max(4 * k, n // 16):
                break
        return left, read


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
               id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k candidates of the largest
    integer inner product of the vectors turned into floor(scale * x)."""
    whole = finite_vectors(vectors, id_col, vector_col).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("x"))
    rows = whole.withColumn("d", F.size("x"))
    asked = rows.where(is_query).dropDuplicates(["vec_id", "x"]).withColumn("q_hash", F.xxhash64("x"))
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    draw = F.pmod(F.xxhash64("x", "vec_id"), F.lit(1 << 30)) < F.lit(min(1.0, FLOOR_ROWS / max(1, n)) * 2.0**30)
    known = _searched(rows.where(draw), asked.withColumn("floor", F.lit(None).cast("long")), k, n_queries, FLOOR_ROWS)
    floors = known.where(F.col("rank") == k).select("query_id", F.col("q_hash").alias("f_hash"), F.col("score").alias("floor"))
    floored = asked.join(floors, (F.col("vec_id") == F.col("query_id")) & (F.col("q_hash") == F.col("f_hash")), "left").drop(
        "query_id", "f_hash")
    return _searched(rows, floored, k, n_queries, n).select("query_id", "rank", "vec_id", "score")


def _searched(rows: DataFrame, asked: DataFrame, k: int, n_queries: int, n: int) -> DataFrame:
    """query_id, q_hash, rank, vec_id, score: each query's best among `rows`."""
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    asks = max(math.ceil(n_queries / QUERY_ROWS), min(math.ceil(32 / blocks), math.ceil(n_queries / 16)), 1)
    left = rows.select("vec_id", "x", "d", F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(asks - 1))).alias("ask"))
    right = asked.select("vec_id", "x", "d", "q_hash", "floor", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                         F.pmod(F.xxhash64("vec_id"), F.lit(asks)).cast("int").alias("ask"))
    right = right.toDF(*right.columns)  # columns of its own: both sides come from the same rows

    def search(candidates, queries):
        out = {c: [np.zeros(0, np.int64)] for c in ("query_id", "q_hash", "vec_id", "score")}
        if candidates.num_rows and queries.num_rows:
            lists = SortedLists(candidates.column("vec_id").to_numpy(), matrix(candidates.column("x"), np.int64))
            q = matrix(queries.column("x"), np.int64)
            for i, (query_id, q_hash, floor) in enumerate(zip(*(queries.column(c).to_pylist() for c in ("vec_id", "q_hash", "floor")))):
                ids, score, _ = lists.top(query_id, q[i], k, floor)
                for c, x in zip(out, (np.full(len(ids), query_id), np.full(len(ids), q_hash), ids, score)):
                    out[c].append(np.asarray(x, np.int64))
        return pa.table({c: np.concatenate(x) for c, x in out.items()})

    found = left.groupBy("block", "ask", "d").cogroup(right.groupBy("block", "ask", "d")).applyInArrow(
        search, "query_id long, q_hash long, vec_id long, score long")
    best = Window.partitionBy("query_id", "q_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
