"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph, which is cut into parts of equal size
with few edges across: halves by the principal direction first, then nodes move
to the part that holds most of their neighbours while sizes stay balanced. A
small classifier (softmax regression) learns which part a vector lies in. Every
row is indexed under its most probable part, and a query goes to its most
probable parts, whose rows are scored exactly.

Only the sample reaches the driver. Parts and queries are split into blocks of
bounded size, so a part that holds a third of all rows is many tasks. How many
parts a query visits is measured on the sample, against brute force: vectors
without clusters need most of them, clustered ones a few. Nearness is
the inner product in double precision, summed in the order of the dimensions.

Vectors null, zero or with null or non-finite components, and rows without an
id, take no part; vectors of different lengths are not compared (each length has
its own index); rows repeated under one id are candidates each, and queries
repeated with an equal vector are asked once; ties go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from weir.llm.vectors import finite_vectors, matrix

SAMPLE_ROWS = 8_192
NEIGHBOURS = 10
BLOCK_ROWS = 16_384
QUERY_ROWS = 8_192


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Each row's k nearest other rows by inner product, in blocks."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), max(k, 0)), np.int64)
    for i in range(0, len(x), 1024):
        score = x[i:i + 1024] @ x.T
        score[np.arange(len(score)), np.arange(i, i + len(score))] = -np.inf
        if k > 0:
            out[i:i + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12) -> np.ndarray:
    """A balanced partition of the graph with few edges across parts."""
    n = len(x)
    part = np.zeros(n, np.int64)
    count = 1
    while count < parts:  # halves by the principal direction
        nxt = np.zeros(n, np.int64)
        for p in range(count):
            own = np.nonzero(part == p)[0]
            if not len(own):
                continue
            centred = x[own] - x[own].mean(axis=0)
            direction = np.linalg.svd(centred.T @ centred)[0][:, 0]
            order = own[np.argsort(centred @ direction, kind="stable")]
            nxt[order[: len(order) // 2]] = 2 * p
            nxt[order[len(order) // 2:]] = 2 * p + 1
        part, count = nxt, 2 * count
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]),
                           np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    most = math.ceil(slack * n / count)
    for _ in range(rounds):
        votes = np.zeros((n, count), np.int32)
        np.add.at(votes, (both[0], part[both[1]]), 1)
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(n), wish] - votes[np.arange(n), part]
        size = np.bincount(part, minlength=count)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[wish[i]] < most:
                size[part[i]] -= 1
                size[wish[i]] += 1
                part[i] = wish[i]
                moved += 1
        if not moved:
            break
    return part


def softmax_regression(x: np.ndarray, part: np.ndarray, parts: int, rounds: int = 150, rate: float = 0.3):
    """Weights (dimension + 1, parts) of the classifier, by Adam on whole batches."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, m, v = (np.zeros((x1.shape[1], parts)) for _ in range(3))
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1
    for t in range(1, rounds + 1):
        z = x1 @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x1.T @ (p - target) / len(x) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def fit(x: np.ndarray, parts: int) -> np.ndarray:
    """Classifier weights from a sample of vectors."""
    u = unit(x)
    return softmax_regression(u, balanced_parts(u, neighbour_graph(u), parts), parts)


def likely_parts(x: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """The m most probable parts of each row, most probable first."""
    u = unit(x)
    z = np.concatenate([u, np.ones((len(u), 1))], axis=1) @ weights
    return np.argsort(-z, axis=1, kind="stable")[:, :m]


def probes_for(x: np.ndarray, weights: np.ndarray, k: int, recall: float, asked: int = 1024) -> int:
    """The fewest parts to visit for which `recall` of the sample's own k nearest
    rows are found, measured by brute force on up to `asked` of its rows."""
    rank_of = np.argsort(likely_parts(x, weights, weights.shape[1]), axis=1)  # place of each part, by row
    home = likely_parts(x, weights, 1)[:, 0]
    held = np.arange(0, len(x), max(1, len(x) // asked))
    k = min(k, len(x) - 1)
    if k < 1:
        return 1
    score = x[held] @ x.T
    score[np.arange(len(held)), held] = -np.inf
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    needed = np.sort(rank_of[held[:, None], home[near]].ravel()) + 1
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)])


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one row with all, summed in the order of the dimensions."""
    out = np.zeros(len(x))
    for i in range(len(q)):
        out += q[i] * x[:, i]
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found. A query visits
    as many parts as give `recall` on the sample."""
    spark = vectors.sparkSession
    rows = finite_vectors(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0)).withColumn("d", F.size("v"))
    tally = {r.d: (r.n, r.q) for r in rows.groupBy("d").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).collect()}
    models, plan = {}, {}
    for d, (n, n_queries) in tally.items():
        parts = 1 << max(0, min(8, round(math.log2(max(1.0, math.sqrt(n) / 4)))))
        keep = max(1, math.ceil(n / SAMPLE_ROWS))
        drawn = rows.where((F.col("d") == d) & (F.pmod(F.xxhash64("vec_id"), F.lit(keep)) == 0)).orderBy(
            F.xxhash64("vec_id", F.lit(1)), "vec_id", "v").limit(2 * SAMPLE_ROWS).select("v").toArrow()
        sample = matrix(drawn.column("v"), float)
        parts = parts if len(sample) >= 4 * parts else 1
        models[d] = fit(sample, parts) if parts > 1 else np.zeros((d + 1, 1))
        plan[d] = (parts, probes_for(sample, models[d], k, recall), max(1, math.ceil(n_queries / QUERY_ROWS)))
    sent = spark.sparkContext.broadcast((models, plan))  # 256 parts at most, of d + 1 weights each

    def route(batches, queries: bool):
        models, plan = sent.value
        for b in batches:
            lengths, ids = b.column(2).to_numpy(), b.column(0).to_numpy()
            for d in np.unique(lengths).tolist():
                at = np.nonzero(lengths == d)[0]
                x = matrix(pa.chunked_array([b.column(1).take(pa.array(at))]), float)
                part = likely_parts(x, models[d], plan[d][1] if queries else 1)
                m = part.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[at], m)), b.column(1).take(pa.array(np.repeat(at, m))),
                     pa.array(np.repeat(lengths[at], m), pa.int32()), pa.array(part.ravel().astype(np.int32))],
                    names=["vec_id", "v", "d", "part"])

    schema = "vec_id long, v array<double>, d int, part int"
    indexed = rows.mapInArrow(lambda b: route(b, False), schema)
    asked = rows.where(is_query).dropDuplicates(["vec_id", "v"]).mapInArrow(lambda b: route(b, True), schema)
    sizes = {(r.d, r.part): r["count"] for r in indexed.groupBy("d", "part").count().collect()}
    total = sum(sizes.values())
    rows_a_block = min(BLOCK_ROWS, max(2048, total // 128))
    cells = [(d, p, max(1, math.ceil(sizes.get((d, p), 0) / rows_a_block)), plan[d][2])
             for d, (parts, _, _) in plan.items() for p in range(parts)]
    # one row per part: how many blocks its rows and the queries fall into
    grid = F.broadcast(spark.createDataFrame(cells, "gd int, gp int, blocks int, asks int"))
    here = (F.col("d") == F.col("gd")) & (F.col("part") == F.col("gp"))
    left = indexed.join(grid, here).select(
        "vec_id", "v", "d", "part", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("ask"))
    right = asked.join(grid, here).select(
        "vec_id", "v", "d", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.col("asks")).cast("int").alias("ask"), F.xxhash64("v").alias("q_hash"))

    def rerank(candidates, queries):
        out = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0),)]
        if candidates.num_rows and queries.num_rows:
            ids, x = candidates.column("vec_id").to_numpy(), matrix(candidates.column("v"), float)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            q = matrix(queries.column("v"), float)
            rough = q @ x.T
            spare = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
            for i, (query_id, q_hash) in enumerate(zip(*(queries.column(c).to_pylist() for c in ("vec_id", "q_hash")))):
                score = np.where(ids == query_id, -np.inf, rough[i])
                bar = np.partition(score, len(score) - k)[len(score) - k] if len(score) > k else -np.inf
                held = np.nonzero((score >= bar - spare[i]) & (ids != query_id))[0]
                exact = inner_products(q[i], x[held])
                best = np.lexsort((ids[held], -exact))[:k]
                out.append((np.full(len(best), query_id), np.full(len(best), q_hash), ids[held][best], exact[best]))
        return pa.table({c: np.concatenate(x) for c, x in zip(("query_id", "q_hash", "vec_id", "score"), zip(*out))})

    keys = ("d", "part", "block", "ask")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        rerank, "query_id long, q_hash long, vec_id long, score double")
    best = Window.partitionBy("query_id", "q_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
