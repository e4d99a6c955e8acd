"""Physical layout operators a user calls (R1-R6) and their reports."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.sources.files import list_files


def _n_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def hash_partition(df: DataFrame, *cols: str | Column, n: int | None = None, splittable: bool = False) -> DataFrame:
    """Hash repartition by keys (nested fields allowed). A later
    join or aggregate on a superset of these keys reuses the partitioning
    and adds no exchange of its own. `splittable` asks for even partitions
    instead: AQE then splits the rows of a hot key over several tasks, and what
    follows must not rely on a key being in one place."""
    if splittable:
        return df.hint("rebalance", *cols)
    return df.repartition(_n_partitions(df, n), *cols)


def coalesce_one(df: DataFrame) -> DataFrame:
    """One partition (one output file). The last stage runs as a single
    task; use only for results known to be small."""
    return df.coalesce(1)


def partition_record_counts(df: DataFrame, dataset: str) -> DataFrame:
    """Records per Spark partition of a dataset."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("records")
    ).withColumn("dataset", F.lit(dataset))


def list_partitions(spark: SparkSession, root: str, col: str, kind: str = "string") -> DataFrame:
    """The partition values of a written table, from its listing alone
    (folders that hold bytes); no file is opened."""
    folder = F.regexp_extract("path", f"/{col}=([^/]+)/[^/]+$", 1)
    listed = list_files(spark, root, recursive=True).filter(F.col("length") > 0)
    value = F.when(folder != "__HIVE_DEFAULT_PARTITION__", F.url_decode(folder)).cast(kind)
    return listed.select(value.alias(col)).distinct()


def first_partition_value(spark: SparkSession, root: str, col: str, kind: str = "string"):
    """The smallest partition value (one aggregate row to the driver)."""
    return list_partitions(spark, root, col, kind).agg(F.min(col).alias("v")).first()["v"]


def timed_layouts(layouts: dict[str, DataFrame], amount: str) -> DataFrame:
    """`compare_layouts` with the seconds that reading and forming each
    layout's every column takes. The `noop` sink keeps what a count would let
    the optimizer leave out."""
    seconds = []
    for name, df in layouts.items():
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        seconds.append((name, time.perf_counter() - began))
    spark = next(iter(layouts.values())).sparkSession
    times = spark.createDataFrame(seconds, "layout string, seconds double")  # one row a layout
    return compare_layouts(layouts, amount).join(F.broadcast(times), "layout")


def compare_layouts(layouts: dict[str, DataFrame], amount: str) -> DataFrame:
    """One row per stored layout of the same result: its rows, the sum
    of a decimal column and its files (those that hold rows)."""
    out = None
    for name, df in layouts.items():
        r = df.select(F.col(amount), F.col("_metadata.file_path").alias("file")).agg(
            F.lit(name).alias("layout"), F.count(F.lit(1)).alias("rows"),
            F.sum(amount).cast("decimal(22,2)").alias(amount), F.count_distinct("file").alias("files"))
        out = r if out is None else out.unionByName(r)
    return out


def files_per_partition(df: DataFrame, col: str) -> DataFrame:
    """Output files per partition value, from file metadata."""
    return df.groupBy(col).agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"))


SALT = "_salt"


def store_for_joins(facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str, facts_table: str, dims_table: str,
                    location: str, buckets: int = 64, salts: int = 8) -> None:
    """J7, R1 as storage: both sides in catalog tables of the same buckets by the
    join key, sorted, so that every later join of them moves no row.

    A key with more than a bucket's fair share of all facts (there are fewer such
    keys than buckets) is split: its facts are dealt over `salts` places by their
    position and its dimension row stands at each of them."""
    total = facts.count()
    hot = facts.groupBy(F.col(fact_key).alias("_hot")).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("_hot").isNotNull() & (F.col("n") > total / buckets)).select("_hot")
    hot = F.broadcast(hot.checkpoint())  # fewer than `buckets` keys
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    salted = facts.withColumn("_place", place).join(hot, F.col(fact_key) == F.col("_hot"), "left").withColumn(
        SALT, F.when(F.col("_hot").isNotNull(), F.col("_place")).otherwise(F.lit(0))).drop("_hot", "_place")
    places = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = dims.join(hot, F.col(dim_key) == F.col("_hot"), "left").withColumn(SALT, F.explode(places)).drop("_hot")
    for df, key, table in ((salted, fact_key, facts_table), (spread, dim_key, dims_table)):
        df.repartition(buckets, key, SALT).write.bucketBy(buckets, key, SALT).sortBy(key, SALT).mode("overwrite").option(
            "path", f"{location.rstrip('/')}/{table}").saveAsTable(table)


def join_stored(spark: SparkSession, facts_table: str, dims_table: str, fact_key: str, dim_key: str) -> DataFrame:
    """The left join of two sides stored by `store_for_joins`, without an exchange."""
    facts, dims = spark.table(facts_table), spark.table(dims_table).withColumnRenamed(SALT, "_dim_salt")
    on = (F.col(fact_key) == F.col(dim_key)) & (F.col(SALT) == F.col("_dim_salt"))
    return facts.join(dims.hint("merge"), on, "left").drop(SALT, "_dim_salt")
