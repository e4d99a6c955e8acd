import glob

from pyspark.sql import functions as F

from weir.operators.joins import broadcast_if_bounded, measure_bounded
from weir.operators.layout import (
    files_per_partition, first_partition_value, hash_partition, join_stored, list_partitions, partition_record_counts,
    store_for_joins, timed_layouts,
)
from weir.operators.sinks import write_ordered_csv, write_partitioned
from weir.sources.files import list_files, read_partition
from weir.sources.tables import spread


def test_measured_broadcast_bound(spark):
    small = spark.range(10).withColumn("s", F.lit("abc"))
    size = measure_bounded(small, max_rows=100)
    assert size.rows == 10 and size.bytes >= 10 * (8 + 3 + 8)
    assert measure_bounded(spark.range(1000), max_rows=100) is None
    _, ok = broadcast_if_bounded(small, max_bytes=1)
    assert not ok
    side, ok = broadcast_if_bounded(small)
    assert ok
    plan = spark.range(100).join(side, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_spread_only_when_under_parallelism(spark):
    one = spark.range(1000).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(1000).repartition(2 * spark.sparkContext.defaultParallelism)
    assert spread(many).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_partitioned_write_layouts(spark, tmp):
    df = spark.range(200).select((F.col("id") % 3).alias("d"), "id")
    write_partitioned(df.repartition(4), f"{tmp}/a", "d")
    write_partitioned(df.repartition(4), f"{tmp}/b", "d", one_file_per_partition=True)
    assert {r.files for r in files_per_partition(spark.read.parquet(f"{tmp}/b"), "d").collect()} == {1}
    assert spark.read.parquet(f"{tmp}/a").count() == 200
    leaf = read_partition(spark, f"{tmp}/a", "d", 1)
    assert "d" in leaf.columns and leaf.count() == len([i for i in range(200) if i % 3 == 1])
    listed = list_files(spark, f"{tmp}/b", recursive=True).collect()
    assert len(listed) == 3 and all(r.folder.startswith("d=") for r in listed)


def test_ordered_csv_parts_hold_consecutive_ranges(spark, tmp):
    df = spark.range(1000).repartition(5).select(F.col("id").alias("k"))
    write_ordered_csv(df, f"{tmp}/csv", ["k"])
    parts = sorted(glob.glob(f"{tmp}/csv/part-*.csv"))
    seen = []
    for p in parts:
        with open(p) as f:
            seen += [int(x) for x in f.read().split()[1:]]
    assert seen == list(range(1000))


def test_hash_partition_and_report(spark):
    df = hash_partition(spark.range(100).withColumn("u", F.col("id") % 7), "u", n=4)
    rep = partition_record_counts(df, "x").collect()
    assert sum(r.records for r in rep) == 100 and len(rep) <= 4


def test_measure_sees_a_file_rewritten_in_place(spark, tmp):
    import os

    path = f"{tmp}/side.json"

    def size(n):
        with open(path, "w") as f:
            f.write("".join(f'{{"k": {i}}}\n' for i in range(n)))
        if os.path.exists(f"{tmp}/.side.json.crc"):
            os.remove(f"{tmp}/.side.json.crc")
        return measure_bounded(spark.read.schema("k long").json(path)).rows

    assert (size(1), size(5000)) == (1, 5000)


def test_measure_gives_up_on_large_files_without_a_scan(spark):
    assert measure_bounded(spark.range(1000), hopeless_bytes=10) is None


def test_partition_values_come_from_the_listing(spark, tmp):
    df = spark.createDataFrame([("2024-01-02", 1), ("2024-01-01", 2), (None, 3), ("a b/c%", 4)], "d string, v int")
    df.write.partitionBy("d").parquet(f"{tmp}/t")
    assert {r.d for r in list_partitions(spark, f"{tmp}/t", "d").collect()} == {"2024-01-02", "2024-01-01", None, "a b/c%"}
    assert first_partition_value(spark, f"{tmp}/t", "d") == "2024-01-01"
    plan = list_partitions(spark, f"{tmp}/t", "d")._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan.replace("FileScan binaryfile", "binaryFile") and "parquet[" not in plan.lower()


def test_timed_layouts(spark, tmp):
    df = spark.range(100).select("id", F.col("id").cast("decimal(12,2)").alias("amount"))
    df.repartition(3).write.parquet(f"{tmp}/a")
    df.coalesce(1).write.parquet(f"{tmp}/b")
    got = {r.layout: r for r in timed_layouts({n: spark.read.parquet(f"{tmp}/{n}") for n in "ab"}, "amount").collect()}
    assert {n: (r.rows, float(r.amount), r.files) for n, r in got.items()} == {"a": (100, 4950.0, 3), "b": (100, 4950.0, 1)}
    assert all(r.seconds > 0 for r in got.values())


def test_stored_join_moves_nothing_and_splits_a_hot_user(spark, tmp):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(
        F.col("id") % 50).alias("u"), F.col("id").alias("v"))
    dims = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    dims = dims.unionAll(spark.createDataFrame([(3, "again")], "k long, name string"))  # an id on two rows
    store_for_joins(facts, dims, "u", "k", "weir_f", "weir_d", tmp, buckets=8, salts=4)
    try:
        joined = join_stored(spark, "weir_f", "weir_d", "u", "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        want = facts.join(dims, F.col("u") == F.col("k"), "left")
        assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count()
        places = spark.table("weir_f").filter("u = 7").select("_salt").distinct().count()
        assert places == 4  # the hot user's facts stand at several places
        assert per_task.agg(F.max("count")).first()[0] < 1000
    finally:
        spark.sql("DROP TABLE weir_f")
        spark.sql("DROP TABLE weir_d")


def test_splittable_partitions_split_a_hot_key(spark):
    hot = spark.range(200_000).select(F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("u"), F.sha2(
        F.col("id").cast("string"), 256).alias("body"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        per_task = hash_partition(hot, "u", splittable=True).groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_if(F.col("u") == 1).alias("hot"), F.max("body"))
        tasks = sum(r.hot > 0 for r in per_task.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert tasks > 1
