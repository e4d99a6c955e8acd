"""Hard negatives by cover trees over norm-augmented candidates.

Candidates are dealt into blocks. Each block's integer vectors x get one more
component, sqrt(m^2 - |x|^2), that lifts them onto a sphere, and a cover tree is
built over the lifted points: the children of a node are a net of its points,
apart by more than the next level's radius and covering the node within it; each
node keeps the distance to its farthest point as covering radius. For a query q
(lifted by a zero) the inner product of any point of a node lies within
|q| * radius of the one with its centre.

A search descends best bound first, one node and then ever more at a time. Nodes wholly outside the score windows asked
for, or below what is already found, are skipped; points are verified by their
exact integer score. First each anchor finds its positives: the best rows of its
own label, in blocks of that label. Each positive gives a window of scores, and a
second search over all blocks finds the best rows of other labels in every window
at once. Both results are merged by rank over the blocks.

Rows with a null id, label or vector, or null or non-finite components, take no
part; rows of the anchor's own id are no candidates; vectors of different lengths
are not compared; ties go to the smaller id; rows repeated under one id are
candidates each, and anchors repeated with equal label and vector are asked once.
Scores beyond 64 bits stay at the nearest 64-bit value, and windows compare
those. A label that holds most rows is split over blocks like any other. Further
columns of any name stay out of the plan; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from weir.llm.vectors import finite_vectors, matrix
from weir.session import scratch_path

BLOCK_ROWS = 8_192
LABEL_BUCKETS = 64
LEAF = 8  # points that are verified at once instead of being split
WAVE = 64  # nodes a search takes from its queue at once, at most
LEVEL = 2.0  # ratio of the radii of two levels
SLACK = 1e-7  # of |q| and the largest norm: covers the rounding of radii and bounds
LONG = 2**63 - 1
EXACT = 2.0**52  # below, sums of integer products are exact in doubles


class CoverTree:
    """A cover tree over the rows of an integer-valued matrix."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.size = float(np.abs(x).max(initial=0.0))
        scaled = x / (self.size or 1.0)
        norms = np.einsum("ij,ij->i", scaled, scaled)
        top = float(norms.max(initial=0.0))
        self.top_norm = math.sqrt(top) * self.size
        self.lifted = np.concatenate([scaled, np.sqrt(np.maximum(top - norms, 0.0))[:, None]], axis=1) / (math.sqrt(top) or 1.0)
        # node: its points (leaf) or its children, which are numbered in a row
        self.radius: list[float] = []
        self.centre: list[int] = []
        self.points: list[np.ndarray | None] = []
        self.children: list[tuple[int, int]] = []
        if len(x):
            self._build()
        self.radius_of = np.array(self.radius) * self.top_norm
        self.centre_of = np.array(self.centre, np.int64)
        self.single = np.array([p is not None and len(p) == 1 for p in self.points], bool)

    def _node(self, centre: int, members: np.ndarray, away: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        self.centre.append(centre)
        self.radius.append(float(away.max(initial=0.0)))
        self.points.append(None)
        self.children.append((0, 0))
        return len(self.centre) - 1, members, away

    def _away(self, centre: int, lifted: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2.0 - 2.0 * (lifted @ self.lifted[centre]), 0.0))  # all lie on the unit sphere

    def _build(self) -> None:
        everyone = np.arange(len(self.x))
        waiting = [self._node(0, everyone, self._away(0, self.lifted))]
        while waiting:
            node, members, away = waiting.pop()
            radius = self.radius[node]
            if len(members) <= LEAF or radius <= 1e-7:
                self.points[node] = members
                continue
            reach = LEVEL ** (math.ceil(math.log(radius, LEVEL)) - 1)  # the next level's radius
            lifted = self.lifted[members]
            centres, owner, near = [self.centre[node]], np.zeros(len(members), np.int64), away.copy()
            while True:  # the farthest point becomes a centre until all are covered
                far = int(near.argmax())
                if near[far] <= reach:
                    break
                to_new = self._away(int(members[far]), lifted)
                closer = to_new < near
                owner[closer], near[closer] = len(centres), to_new[closer]
                centres.append(int(members[far]))
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(centres) + 1))
            first = len(self.centre)
            for i, centre in enumerate(centres):
                own = order[cuts[i]:cuts[i + 1]]
                waiting.append(self._node(centre, members[own], near[own]))
            self.children[node] = (first, len(self.centre))

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact integer scores, kept within 64 bits."""
        if len(q) * self.size * float(np.abs(q).max(initial=0.0)) < EXACT:
            return (self.x[rows] @ q).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(self.x[i], q)) for i in rows]
        return np.array([max(-LONG - 1, min(LONG, s)) for s in exact], np.int64)

    def search(self, q: np.ndarray, k: int, low: np.ndarray, high: np.ndarray, ids: np.ndarray, open_to: np.ndarray):
        """For each window [low, high] the k best rows of `open_to`: (window, id,
        score) arrays. Rows verified are returned as a count beside them."""
        best: list[list[tuple[int, int]]] = [[] for _ in low]  # heaps of (score, -id): the worst on top
        windows = [(int(a), int(b)) for a, b in zip(low, high)]
        reach = float(np.linalg.norm(q))
        spare = SLACK * (reach * self.top_norm + 1.0)
        verified, queue = 0, []

        def may_help(most: float, least: float) -> bool:
            return any(most >= a and least <= b and (len(h) < k or most >= h[0][0])
                       for (a, b), h in zip(windows, best) if a <= b)

        def verify(rows: np.ndarray) -> None:
            nonlocal verified
            rows = rows[open_to[rows]]
            verified += len(rows)
            score = self.scores(q, rows)
            for (a, b), h in zip(windows, best):
                at = np.nonzero((score >= max(a, h[0][0] if len(h) == k else a)) & (score <= b))[0]
                if len(at) > k:
                    at = at[np.lexsort((ids[rows[at]], -score[at]))[:k]]
                for i in at:
                    entry = (int(score[i]), -int(ids[rows[i]]))
                    if len(h) < k:
                        heapq.heappush(h, entry)
                    elif entry > h[0]:
                        heapq.heapreplace(h, entry)

        if len(q) * self.size * float(np.abs(q).max(initial=0.0)) >= 2.0**62:  # no bound in doubles: verify all
            verify(np.arange(len(self.x)))
        elif len(self.centre):
            queue = [(-math.inf, 0, math.inf, -math.inf)]
        cap = max((float(b) for a, b in windows if a <= b), default=0.0)  # a window's end caps how good a node can be
        wave = 1
        while queue:
            nodes: list[int] = []
            while queue and len(nodes) < wave:
                _, node, most, least = heapq.heappop(queue)
                if may_help(most, least):
                    nodes.append(node)
            wave = min(2 * wave, WAVE)  # few nodes while they may still settle the search, then many at once
            leaves = [self.points[n] for n in nodes if self.points[n] is not None]
            if leaves:
                verify(np.concatenate(leaves))
            below = [np.arange(*self.children[n]) for n in nodes if self.points[n] is None]
            if not below:
                continue
            child = np.concatenate(below)
            middle = self.x[self.centre_of[child]] @ q
            room = reach * self.radius_of[child] + spare
            most, least = middle + room, middle - room
            wanted = np.zeros(len(child), bool)
            for (lo, hi), h in zip(windows, best):
                bar = max(lo, h[0][0]) if len(h) == k else lo
                wanted |= (most >= bar) & (least <= hi)
            single = self.single[child]
            alone = child[wanted & single]
            if len(alone):  # single points need no place in the queue
                verify(self.centre_of[alone])
            for i in np.nonzero(wanted & ~single)[0]:
                heapq.heappush(queue, (-min(float(most[i]), cap), int(child[i]), float(most[i]), float(least[i])))
        found = [(w, -i, s) for w, h in enumerate(best) for s, i in h]
        return (*(np.array(c, np.int64) for c in (zip(*found) if found else ((), (), ()))), verified)


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3,
                   least_percent: int = 50, most_percent: int = 95, scale: int = 256,
                   id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor and each of its `positives` best rows of the same label, the
    `negatives` best rows of other labels whose score is between `least_percent`
    and `most_percent` of the positive's."""
    labelled = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), label.cast("string").alias("label"),
                              F.coalesce(is_anchor, F.lit(False)).alias("anchor")).where("label is not null")
    good = finite_vectors(labelled, "vec_id", "v", "label", "anchor")
    rows = good.select("vec_id", "label", "anchor", F.size("v").alias("d"), F.transform("v", lambda c: F.floor(c * scale).cast("double")).alias("x"),
        F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int").alias("bucket"))
    sizes = {r.bucket: r["count"] for r in rows.groupBy("bucket").count().collect()}  # LABEL_BUCKETS rows at most
    in_block = min(BLOCK_ROWS, max(1024, sum(sizes.values()) // 32))
    grid = [(b, math.ceil(n / in_block)) for b, n in sizes.items()]
    blocks = F.broadcast(vectors.sparkSession.createDataFrame(grid, "bucket int, blocks int"))
    asked = rows.where("anchor").select("vec_id", "label", "d", "x", "bucket").withColumn(
        "a_hash", F.xxhash64("label", "x")).dropDuplicates(["vec_id", "a_hash"])
    dealt = rows.join(blocks, "bucket").select("vec_id", "label", "d", "x", "bucket", F.pmod(
        F.xxhash64("vec_id", "x"), F.col("blocks")).cast("int").alias("block"))

    def run(candidates, queries, k: int, same_label: bool):
        out = [(np.zeros(0, np.int64),) * 5]
        if candidates.num_rows and queries.num_rows:
            ids = candidates.column("vec_id").to_numpy()
            names, code = np.unique(np.array(candidates.column("label").to_pylist(), object), return_inverse=True)
            code_of = {n: i for i, n in enumerate(names)}
            tree = CoverTree(matrix(candidates.column("x"), float))
            q = matrix(queries.column("x"), float)
            low, high = (queries.column(c).to_pylist() for c in ("low", "high"))
            for i, (vec_id, a_hash, name) in enumerate(zip(*(queries.column(c).to_pylist() for c in ("vec_id", "a_hash", "label")))):
                mine = code == code_of.get(name, -1)
                window, found, score, _ = tree.search(
                    q[i], k, np.array(low[i], object), np.array(high[i], object), ids, (mine == same_label) & (ids != vec_id))
                out.append((np.full(len(window), vec_id), np.full(len(window), a_hash), window, found, score))
        names = ("anchor_id", "a_hash", "window", "found_id", "score")
        return pa.table({c: np.concatenate(x).astype(np.int64) for c, x in zip(names, zip(*out))})

    keys, schema = ("bucket", "block", "d"), "anchor_id long, a_hash long, window long, found_id long, score long"

    def searched(queries: DataFrame, k: int, same_label: bool) -> DataFrame:
        renewed = queries.toDF(*queries.columns)  # columns of its own: both sides come from the same rows
        return dealt.groupBy(*keys).cogroup(renewed.groupBy(*keys)).applyInArrow(
            lambda c, q: run(c, q, k, same_label), schema)

    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    own = asked.join(blocks, "bucket").select(
        "vec_id", "a_hash", "label", "d", "x", F.array(F.lit(-LONG - 1)).alias("low"), F.array(F.lit(LONG)).alias("high"),
        "bucket", everywhere)
    near = _merged(searched(own, positives, True), ["anchor_id", "a_hash"], positives)
    # `positives` entries at most per anchor; stored, as the windows and the result both need them
    windows = near.groupBy("anchor_id", "a_hash").agg(
        F.sort_array(F.collect_list(F.struct("rank", "found_id", "score"))).alias("near"))
    path = scratch_path(vectors.sparkSession, "positives")
    windows.write.mode("overwrite").parquet(path)
    windows = vectors.sparkSession.read.parquet(path)
    percent = F.lit(100).cast("decimal(20,0)")

    def bound(share: int, rounding) -> Column:
        return F.transform("near", lambda p: rounding(p["score"].cast("decimal(20,0)") * F.lit(share) / percent).cast("long"))

    windows = windows.withColumns({"low": bound(least_percent, F.ceil), "high": bound(most_percent, F.floor)})
    asked_again = asked.drop("bucket").join(windows.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "a_hash"])
    spread = asked_again.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(LABEL_BUCKETS - 1)))).join(
        blocks, "bucket").select("vec_id", "a_hash", "label", "d", "x", "low", "high", "bucket", everywhere)
    far_rows = _merged(searched(spread, negatives, False), ["anchor_id", "a_hash", "window"], negatives)
    positive = windows.select("anchor_id", "a_hash", F.posexplode("near").alias("window", "p"))
    return far_rows.join(positive, ["anchor_id", "a_hash", "window"]).select(
        "anchor_id", F.col("p.found_id").alias("positive_id"), "rank", F.col("found_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
