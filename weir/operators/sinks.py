"""Sinks (K1-K8): partitioned writers, ordered CSV, insert-if-absent
loading with a file manifest, table creation.

All writers are plain DataFrameWriter jobs: tasks write in parallel and the
driver only commits. Loading keeps the target's semantics of a unique key
with ON CONFLICT DO NOTHING: the first incoming row per key wins and keys
already present in the target are never replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A12 / A13 ------------------------------------------------------------------
def observed(inserted: DataFrame, name: str) -> dict[str, int]:
    """What an `INSERT` statement has observed (`DataFrame.observe` by name),
    given the statement's result; a plan known to be empty observes nothing.

    The counts are read from the statement's executed plan. An `Observation`
    object would put its manager into the session, and tasks that carry the
    session (those of Spark's tree learners do) cannot be sent from then on."""
    spark = inserted.sparkSession
    plan = inserted._jdf.queryExecution().commandExecuted().commandPhysicalPlan()
    metrics = getattr(spark._jvm.org.apache.spark.sql.execution, "CollectMetricsExec$")
    found = getattr(metrics, "MODULE$").collect(plan).get(name)
    if found.isEmpty():
        return {}
    row = found.get()
    return {column: row.get(i) for i, column in enumerate(row.schema().fieldNames())}


def write_observed(df: DataFrame, path: str, name: str) -> dict[str, int]:
    """Appends to a Parquet folder; returns what the job observed under `name`."""
    spark, table = df.sparkSession, f"written_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
    try:
        return observed(spark.sql(f"INSERT INTO {table} SELECT * FROM {{df}}", df=df), name)
    finally:
        spark.sql(f"DROP TABLE {table}")  # the folder stays: the table is external


# K1 / K2 -------------------------------------------------------------------
def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str,
    mode: str = "overwrite",
    one_file_per_partition: bool = False,
    dynamic_overwrite: bool = False,
    few_values: bool = False,
) -> None:
    """Parquet partitioned by one column.

    Default: a REBALANCE hint on the partition column, so AQE evens out the
    write tasks (a hot value is split over several files, tiny ones are
    merged) instead of every task writing a file into every folder.
    `one_file_per_partition` hash-partitions by the column instead: one
    task and one file per value (meant for small results such as the KPI).
    `few_values` writes without any shuffle or sort: for a column with a
    handful of values, every task writing one file into each folder it holds
    is both the cheapest and the most parallel layout. A task keeps up to
    `OPEN_WRITERS` files open; only the rows of further values are sorted.
    """
    if one_file_per_partition:
        df = df.repartition(partition_col)
    elif not few_values:
        df = df.hint("rebalance", partition_col)
    w = df.write.partitionBy(partition_col).mode(mode)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    with _open_writers(df.sparkSession, OPEN_WRITERS if few_values else None):
        w.parquet(path)


OPEN_WRITERS = 8  # files a task of a `few_values` write keeps open


@contextmanager
def _open_writers(spark: SparkSession, files: int | None):
    """Lets a partitioned write keep that many files open per task in place of
    sorting the task's rows by folder; the session's own setting comes back."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    if files is not None:
        spark.conf.set(name, str(files))
    try:
        yield
    finally:
        if files is not None:
            spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# K4 ------------------------------------------------------------------------
def write_ordered_csv(df: DataFrame, path: str, order_by: Sequence[str | Column],
                      single_file: bool = False) -> None:
    """Header CSV in global key order.

    Default: the sort range-partitions the rows and every task writes its
    range, so part-00000, part-00001, ... hold consecutive key ranges - read
    in name order, the folder is the ordered file. `single_file=True` adds
    `coalesce(1)` for the one-file form of the reference; that funnels all
    rows through one task and is meant for small outputs only.
    """
    out = df.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


# K5 / J6 -------------------------------------------------------------------
def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by `order_by`, then the remaining
    columns as tie-breakers (a total order, so the winner is deterministic).

    A grouped min over a struct, not a window: the aggregate is combined
    map-side, so a key holding a third of all rows is reduced inside every
    map task instead of being sorted in a single one.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
    fields += [F.col(c).alias(f"r{i}") for i, c in enumerate(rest)]
    picked = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_w"))
    out = [F.col(key)]
    out += [F.col(f"_w.o{i}").alias(c) for i, c in enumerate(order_by)]
    out += [F.col(f"_w.r{i}").alias(c) for i, c in enumerate(rest)]
    return picked.select(*out).select(*df.columns)


@dataclass(frozen=True)
class KeyBounds:
    """What one pass over a load's keys tells: how many there are, their bytes, the smallest and the largest."""
    rows: int
    bytes: int
    low: object
    high: object


def key_measures(key: str) -> list[Column]:
    """The aggregates behind `KeyBounds`, to be taken along in a pass that is made anyway."""
    size = F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) + 16
    return [F.count(key).alias("rows"), F.sum(F.when(F.col(key).isNotNull(), size)).alias("bytes"),
            F.min(key).alias("low"), F.max(key).alias("high")]


def key_bounds(df: DataFrame, key: str) -> KeyBounds:
    row = df.select(key).agg(*key_measures(key)).first()
    return KeyBounds(row["rows"], row["bytes"] or 0, row["low"], row["high"])


def rows_to_insert(incoming: DataFrame, target: DataFrame, key: str, order_by: Sequence[str],
                   bounds: KeyBounds | None = None, broadcast_max_bytes: int | None = None,
                   buckets: int | None = None) -> DataFrame:
    """Rows an INSERT ... ON CONFLICT (key) DO NOTHING would add: first row
    per key in `order_by` order, minus keys already in the target.

    The target only grows, while a load is small. One pass over the incoming
    keys bounds them (`bounds`, if the caller has it); the target's scan
    carries these bounds, so row groups of other key ranges are not read. A
    few keys are pushed as a list, for which Parquet asks its bloom filters.
    Within the broadcast bound the keys are broadcast and the target's keys
    stream through without a shuffle, only those present coming back. Beyond
    it the first rows are dealt to the target's `buckets`, where the bucketed
    target meets them without an exchange of its own; a target without
    buckets is a plain anti join.
    """
    from weir.operators.joins import DEFAULT_MAX_BYTES, DEFAULT_MAX_ROWS

    bounds = bounds or key_bounds(incoming, key)
    firsts = first_per_key(incoming, key, order_by)
    known = target.select(key).filter(F.col(key).between(F.lit(bounds.low), F.lit(bounds.high)))
    keys = incoming.select(key).filter(F.col(key).isNotNull()).distinct()
    few = int(target.sparkSession.conf.get("spark.sql.parquet.pushdown.inFilterThreshold", "10"))
    limit = DEFAULT_MAX_BYTES if broadcast_max_bytes is None else broadcast_max_bytes
    if bounds.rows <= few and limit:
        known = known.filter(F.col(key).isin([r[0] for r in keys.collect()]))  # `few` rows at most
    if bounds.rows <= DEFAULT_MAX_ROWS and bounds.bytes <= limit:
        # both sides below are bounded by the measured incoming keys
        present = known.join(F.broadcast(keys), key, "left_semi")
        return firsts.join(F.broadcast(present.distinct()), on=key, how="left_anti")
    if buckets:
        # the load alone moves, reduced to its first rows; observing them keeps the optimizer from
        # moving the join below the grouping, where every row of a hot key would go to one bucket
        dealt = firsts.repartition(buckets, key).observe("first_rows", F.count(F.lit(1)).alias("rows"))
        return dealt.join(known.hint("merge"), on=key, how="left_anti")
    return firsts.join(known, on=key, how="left_anti")


# K6 ------------------------------------------------------------------------
MANIFEST_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType(), False),
    T.StructField("processed_at", T.TimestampType(), True),
    T.StructField("rows_loaded", T.LongType(), True),
])


def manifest_append(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries whose filename is not yet in the manifest (ON CONFLICT
    (filename) DO NOTHING)."""
    return entries.join(manifest.select("filename"), on="filename", how="left_anti")


# K8 ------------------------------------------------------------------------
def create_table_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An empty Parquet table with the declared columns, unless data is
    already there; returns the table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        return spark.read.schema(schema).parquet(path)
