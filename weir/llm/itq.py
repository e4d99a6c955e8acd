"""Near-duplicate vectors by iterative quantisation and multi-index hashing.

A bounded sample gives a rotation whose signs are balanced binary codes close to
the centred unit vectors (iterative quantisation; more than 64 dimensions are
first projected on the 64 leading ones, fewer get several rotations). Every
distinct vector gets its 64-bit code. The code is cut into substrings, each the
key of one Hamming table; two vectors meet in a table when their substrings differ
in at most one bit. How many tables there are, and how many bits the whole codes
may differ in, is measured on the sample at exactly the wanted cosine, for the
recall asked. Vectors that meet are compared by the cosine of the originals.

A table is cut into bins by the leading bits of its substring, so a row goes to
its own bin and to those one leading bit away. Bins of many rows (a group of near
copies may hold a third of all) are cut into blocks and compared block by block
with matrix products; pairs are never written out: a task gives each row's link
count and a tree of the links it saw. A pair counts in the first table where it
meets. Equal vectors are one node with a count.

Defined cases: vectors null, zero or with null or non-finite components, and rows
without an id, link with nothing; vectors of different lengths are not compared
(each length has its own rotation); equal vectors under any ids link; every input
row gives one row, and rows repeated under one id are vectors of their own;
further columns of any name stay out of the plan; an empty table gives an empty
result. Cosines are of doubles, scaled by powers of two so that no norm overflows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from weir.llm.graph import components
from weir.llm.vectors import finite_vectors, matrix
from weir.session import scratch_path

BITS = 64
SAMPLE_ROWS = 8_192  # of each vector length: a bounded sample fits the rotation
BIN_ROWS = 8_192
BLOCK_ROWS = 16_384
MOST_TABLES = 16
RUN = 1 << 16  # pairs of two substring runs from which they are compared by matrix products
PAIRS = 1 << 19  # pairs looked at in one go
EDGE = 1e-9  # cosines this near the threshold are computed again, in one fixed way


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by a power of two to a largest component of at most 1, and their unit vectors."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])
    return x, x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def learn_rotation(u: np.ndarray, bits: int = BITS, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Mean and (dimension, bits) projection whose signs are the code bits."""
    rng = np.random.default_rng(0)
    mean = u.mean(axis=0)
    x, d = u - mean, u.shape[1]
    base = np.eye(d)
    if d > bits:
        base = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :bits]
        x = x @ base
    width = x.shape[1]
    parts = []
    for _ in range(math.ceil(bits / width)):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(rounds):  # nearest codes, then the rotation nearest to them
            left, _, right = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
            r = (left @ right).T
        parts.append(base @ r)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def codes(u: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bit = (u - mean) @ projection >= 0
    return np.packbits(bit, axis=1, bitorder="little").view("<u8")[:, 0].astype(np.uint64)


def substrings(tables: int, bits: int = BITS) -> list[tuple[int, int]]:
    """First bit and width of each table's substring."""
    base, extra = divmod(bits, tables)
    return [(t * base + min(t, extra), base + (t < extra)) for t in range(tables)]


def differing(x: np.ndarray, start: int, width: int) -> np.ndarray:
    return np.bitwise_count((x >> np.uint64(start)) & np.uint64((1 << width) - 1))


def calibrate(u: np.ndarray, mean: np.ndarray, projection: np.ndarray, cosine: float, recall: float) -> tuple[int, int]:
    """Tables and largest code distance for which `recall` of the pairs at exactly
    this cosine meet, measured on partners made for the sample's vectors."""
    rng = np.random.default_rng(1)
    u = u[:4096]
    side = rng.normal(size=u.shape)
    side -= np.einsum("ij,ij->i", side, u)[:, None] * u
    length = np.linalg.norm(side, axis=1, keepdims=True)
    partner = cosine * u + math.sqrt(max(0.0, 1 - cosine * cosine)) * side / np.where(length > 1e-9, length, 1.0)
    x = codes(u, mean, projection) ^ codes(partner, mean, projection)
    radius = int(np.quantile(np.bitwise_count(x), 1 - (1 - recall) / 2, method="higher"))
    near = np.bitwise_count(x) <= radius
    for tables in range(2, MOST_TABLES + 1):
        meets = np.any([differing(x, *s) <= 1 for s in substrings(tables)], axis=0)
        if (near & meets).mean() >= recall:
            break
    return tables, radius


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives the rows tied by edges (a, b) their smallest label."""
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)  # a label's own row follows
        label[:] = label[label]
        if np.array_equal(before, label):
            return


class Bin:
    """The rows of one task: links and their tree among pairs that meet here first."""

    def __init__(self, x: np.ndarray, code: np.ndarray, copies: np.ndarray, table: int, tables: int, radius: int, cosine: float):
        self.x, self.u = unit(x)
        self.code, self.copies, self.cosine, self.radius = code, copies, cosine, radius
        self.cuts = substrings(tables)
        self.earlier, (self.start, self.width) = self.cuts[:table], self.cuts[table]
        self.key = ((code >> np.uint64(self.start)) & np.uint64((1 << self.width) - 1)).astype(np.int64)
        self.links = np.zeros(len(x), np.int64)
        self.label = np.arange(len(x))

    def _meet(self, x: np.ndarray) -> np.ndarray:
        ok = np.bitwise_count(x) <= self.radius
        for s in self.earlier:
            ok &= differing(x, *s) > 1
        return ok

    def exactly(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the cosine reaches the threshold, from the originals."""
        p, q = self.x[a], self.x[b]
        dot, pp, qq = (np.einsum("ij,ij->i", *s) for s in ((p, q), (p, p), (q, q)))
        return dot / (np.sqrt(pp) * np.sqrt(qq)) >= self.cosine

    def _few(self, a: np.ndarray, b: np.ndarray) -> None:
        at = np.nonzero(self._meet(self.code[a] ^ self.code[b]))[0]
        self._alike(a[at], b[at])

    def _alike(self, a: np.ndarray, b: np.ndarray) -> None:
        for i in range(0, len(a), 1 << 15):
            p, q = a[i:i + (1 << 15)], b[i:i + (1 << 15)]
            ok = self.exactly(p, q)
            p, q = p[ok], q[ok]
            np.add.at(self.links, p, self.copies[q])
            np.add.at(self.links, q, self.copies[p])
            joined(self.label, p, q)

    def _many(self, a: np.ndarray, b: np.ndarray, triangle: bool) -> None:
        for i in range(0, len(a), 1024):
            p = a[i:i + 1024]
            for j in range(i if triangle else 0, len(b), 1024):
                q = b[j:j + 1024]
                ok = self._meet(self.code[p][:, None] ^ self.code[q][None, :])
                if triangle and i == j:
                    ok = np.triu(ok, 1)
                met = np.count_nonzero(ok)
                if met < ok.size // 16:  # few: as pairs
                    if met:
                        one, two = np.nonzero(ok)
                        self._alike(p[one], q[two])
                    continue
                cos = self.u[p] @ self.u[q].T
                unsure = np.nonzero(ok & (np.abs(cos - self.cosine) <= EDGE))
                ok &= cos >= self.cosine
                ok[unsure] = self.exactly(p[unsure[0]], q[unsure[1]])
                self.links[p] += ok @ self.copies[q]
                self.links[q] += self.copies[p] @ ok
                self._tie(p, q, ok)

    def _tie(self, p: np.ndarray, q: np.ndarray, ok: np.ndarray) -> None:
        """Ties the rows of p and q that a matrix links, by their smallest labels."""
        none = len(self.label)
        while min(self.label[p].min(), self.label[q].min()) != max(self.label[p].max(), self.label[q].max()):
            row = np.where(ok, self.label[q][None, :], none).min(axis=1)
            column = np.where(ok, self.label[p][:, None], none).min(axis=0)
            before = self.label.copy()
            joined(self.label, np.concatenate([p[row < none], q[column < none]]),
                   np.concatenate([row[row < none], column[column < none]]))
            if np.array_equal(before, self.label):
                return

    def compare(self, left: np.ndarray, right: np.ndarray | None, flips: range) -> None:
        """Rows `left` with `right` (None: with each other) whose keys are equal or
        differ in one bit of `flips`."""
        def runs(rows):
            rows = rows[np.argsort(self.key[rows], kind="stable")]
            value, first, count = np.unique(self.key[rows], return_index=True, return_counts=True)
            return rows, value, first, count

        a_rows, a_key, a_first, a_count = runs(left)
        b_rows, b_key, b_first, b_count = (a_rows, a_key, a_first, a_count) if right is None else runs(right)
        if not len(a_rows) or not len(b_rows):
            return
        for bit in (None, *flips):
            asked = np.arange(len(a_key))
            if bit is not None and right is None:
                asked = asked[a_key >> bit & 1 == 0]  # each pair of runs once
            wish = a_key[asked] ^ (0 if bit is None else 1 << bit)
            at = np.minimum(np.searchsorted(b_key, wish), len(b_key) - 1)
            hit = b_key[at] == wish
            p, q, triangle = asked[hit], at[hit], right is None and bit is None
            big = a_count[p] * b_count[q] > RUN
            for i, j in zip(p[big], q[big]):
                self._many(a_rows[a_first[i]:a_first[i] + a_count[i]], b_rows[b_first[j]:b_first[j] + b_count[j]], triangle)
            p, q = p[~big], q[~big]
            row = np.repeat(a_first[p], a_count[p]) + _counted(a_count[p])
            start, length = np.repeat(b_first[q], a_count[p]), np.repeat(b_count[q], a_count[p])
            if triangle:
                length = start + length - row - 1
                start = row + 1
            done = np.concatenate([[0], np.cumsum(length)])
            i = 0
            while i < len(row):
                j = max(i + 1, int(np.searchsorted(done, done[i] + PAIRS, side="right")) - 1)
                one = np.repeat(row[i:j], length[i:j])
                two = np.repeat(start[i:j], length[i:j]) + _counted(length[i:j])
                self._few(a_rows[one], b_rows[two])
                i = j


def _counted(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, one after the other."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _fit(cosine: float, recall: float):
    def fit(key, sample):
        _, u = unit(matrix(sample.column("v"), float))
        u = u[np.lexsort(u.T[::-1])]  # whatever order the shuffle gave
        u = u[np.random.default_rng(2).permutation(len(u))]
        mean, projection = learn_rotation(u)
        tables, radius = calibrate(u, mean, projection, cosine, recall)
        return pa.table({"d": pa.array([u.shape[1]], pa.int32()), "mean": [mean], "projection": [projection.ravel()],
                         "tables": pa.array([tables], pa.int32()), "radius": pa.array([radius], pa.int32())})
    return fit


def _coded(key, rows, models):
    schema = pa.schema([("vec_id", pa.int64()), ("copies", pa.int64()), ("d", pa.int32()), ("v", pa.list_(pa.float64())),
                        ("code", pa.int64()), ("tables", pa.int32()), ("radius", pa.int32())])
    if not rows.num_rows:
        return schema.empty_table()
    model = models.to_pylist()[0]
    _, u = unit(matrix(rows.column("v"), float))
    code = codes(u, np.array(model["mean"]), np.array(model["projection"]).reshape(u.shape[1], -1))
    n = len(code)
    return pa.table([rows.column("vec_id"), rows.column("copies"), pa.array(np.full(n, model["d"], np.int32)), rows.column("v"),
                     pa.array(code.view(np.int64)), pa.array(np.full(n, model["tables"], np.int32)),
                     pa.array(np.full(n, model["radius"], np.int32))], schema=schema)


def _linked(cosine: float):
    def linked(key, rows):
        _, table, _, i, j, leading = (k.as_py() for k in key)
        one = rows.slice(0, 1).to_pylist()[0]
        node, vec_id, block, probe = (rows.column(c).to_numpy() for c in ("node", "vec_id", "block", "probe"))
        rows_here = Bin(matrix(rows.column("v"), float), rows.column("code").to_numpy().view(np.uint64),
                        rows.column("copies").to_numpy(), table, one["tables"], one["radius"], cosine)
        low = rows_here.width - leading  # bits below those that name the bin
        if j < 0:
            rows_here.compare(np.nonzero(probe == 0)[0], np.nonzero(probe == 1)[0], range(low, rows_here.width))
        elif i == j:
            rows_here.compare(np.arange(len(node)), None, range(low))
        else:
            rows_here.compare(np.nonzero(block == i)[0], np.nonzero(block == j)[0], range(low))
        at = np.nonzero(rows_here.links)[0]
        tied = rows_here.label[at]
        return pa.table({"vec_id": vec_id[at], "node": node[at], "links": rows_here.links[at], "root_id": vec_id[tied], "root": node[tied]})
    return linked


def link_counts(coded: DataFrame, cosine: float) -> DataFrame:
    """vec_id, node, links, root_id, root of every task: how many rows a node links
    to among the pairs that meet there, and a node of the task it is tied to."""
    sizes = coded.groupBy("d").agg(F.ceil(F.log2(F.count("*") / F.lit(BIN_ROWS))).cast("int").alias("needed"))
    placed = coded.join(sizes, "d").withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tables") - 1)))
    placed = placed.withColumn("width", F.expr(
        f"cast(({BITS} div tables) + if(t < {BITS} % tables, 1, 0) as int)"))
    placed = placed.withColumn("leading", F.greatest(F.lit(0), F.least("needed", "width")))
    placed = placed.withColumn("own", F.expr(
        f"shiftrightunsigned(code, cast(t * ({BITS} div tables) + least(t, {BITS} % tables) + width - leading as int))"
        " & (shiftleft(1L, leading) - 1)"))
    # the own bin, and bins with one more leading bit set: those rows are met there
    near = F.expr("filter(transform(sequence(0, greatest(leading - 1, 0)), i -> own | shiftleft(1L, i)), b -> b <> own)")
    touched = placed.withColumn("bin", F.explode(F.concat(F.array("own"), near))).withColumn(
        "probe", (F.col("bin") != F.col("own")).cast("int"))
    at = ["d", "t", "bin"]
    loads = touched.groupBy(*at).agg(
        F.ceil(F.sum(1 - F.col("probe")) / BLOCK_ROWS).cast("int").alias("blocks"),
        F.ceil(F.sum("probe") / BLOCK_ROWS).cast("int").alias("probes"))
    shares = F.when(F.col("probe") == 1, F.col("probes")).otherwise(F.col("blocks"))
    dealt = touched.join(loads.where("blocks > 0"), at).withColumn("block", F.pmod(F.xxhash64("node"), shares).cast("int"))
    # tasks (i, j): two blocks of a bin, or block i and, as -1 - p, share p of the rows from other bins
    own_tasks = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))),
        F.filter(F.transform(F.sequence(F.lit(0), F.col("probes")), lambda p: F.struct(
            F.col("block").alias("i"), (-p).alias("j"))), lambda t: t["j"] < 0))
    probe_tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(
        i.alias("i"), (-1 - F.col("block")).alias("j")))
    tasks = dealt.withColumn("task", F.explode(F.when(F.col("probe") == 1, probe_tasks).otherwise(own_tasks)))
    return tasks.select("vec_id", "node", "copies", "d", "v", "code", "tables", "radius", "t", "bin", "leading", "block", "probe",
                        "task.i", "task.j").groupBy("d", "t", "bin", "i", "j", "leading").applyInArrow(
        _linked(cosine), "vec_id long, node long, links long, root_id long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.97,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row: how many other rows have
    at least this cosine with it (of the pairs found), and the smallest id
    reachable by links. `recall` is that of pairs at the threshold itself; closer
    pairs are found more surely."""
    spark = vectors.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"itq-{name}")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    valid = finite_vectors(vectors, id_col, vector_col).where(F.exists("v", lambda c: c != 0))
    distinct = written(valid.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).withColumn(
        "d", F.size("v")), "distinct")
    counts = distinct.groupBy("d").agg(F.count("*").alias("n"))
    drawn = distinct.select("d", "v").join(counts, "d").where(
        F.pmod(F.xxhash64("v", F.lit(7)), F.lit(1 << 30)) < F.lit(float(SAMPLE_ROWS << 30)) / F.col("n"))
    models = drawn.groupBy("d").applyInArrow(
        _fit(cosine, recall), "d int, mean array<double>, projection array<double>, tables int, radius int")
    parts = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    spread = distinct.join(counts, "d").select("vec_id", "copies", "d", "v", F.pmod(F.xxhash64("v"), parts).cast("int").alias("part"))
    everywhere = models.join(counts.withColumnRenamed("d", "of"), F.col("d") == F.col("of")).select(
        "d", "mean", "projection", "tables", "radius", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    everywhere = everywhere.toDF(*everywhere.columns)
    coded = written(spread.groupBy("d", "part").cogroup(everywhere.groupBy("d", "part")).applyInArrow(
        _coded, "vec_id long, copies long, d int, v array<double>, code long, tables int, radius int").withColumn(
        "node", F.monotonically_increasing_id()), "coded")

    found = written(link_counts(coded, cosine), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    # nodes ordered by (vec_id, node): a component's root then carries its smallest id
    roots = components(found.where("node <> root").select(
        F.struct("vec_id", "node").alias("a"), F.struct(F.col("root_id").alias("vec_id"), F.col("root").alias("node")).alias("b")))
    roots = roots.select(F.col("node.node").alias("node"), F.col("root.vec_id").alias("least"))
    nodes = coded.select("node", F.col("vec_id").alias("first_id"), "copies", "v").join(links, "node", "left").join(
        roots, "node", "left").select(
        "first_id", "copies", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "first_id").alias("component_id"))
    single = nodes.where("copies = 1").select(F.col("first_id").alias("vec_id"), "n_links", "component_id")
    copied = valid.join(nodes.where("copies > 1").select("v", "n_links", "component_id"), "v").select(
        "vec_id", "n_links", "component_id")
    good = F.coalesce(F.forall(F.col(vector_col), lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False))), F.lit(False))
    nonzero = F.exists(F.col(vector_col), lambda c: c != 0)
    odd = vectors.where(~(F.col(id_col).isNotNull() & good & F.coalesce(nonzero, F.lit(False)))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col(id_col).cast("long").alias("component_id"))
    return single.union(copied).union(odd).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
