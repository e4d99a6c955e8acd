"""KPI query keys over the driver tables (flagship + its single steps)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import kpi as K
from weir.operators import layout as L
from weir.operators.joins import broadcast_if_bounded
from weir.operators.sinks import write_partitioned
from weir.session import scratch_path
from weir.sources.datasets import kpi_events, kpi_items, kpi_users
from weir.sources.files import read_partition


def _inputs(spark: SparkSession, sf_dir: str):
    return kpi_events(spark, sf_dir), kpi_items(spark, sf_dir), kpi_users(spark, sf_dir)


def daily_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: P1-P3, P5, F1, J1, J2, A1-A5, W1."""
    ev, items, users = _inputs(spark, sf_dir)
    return K.daily_kpi(ev, items, users)


def derive_time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp and date parsed from the ISO text."""
    ev = K.with_time_columns(kpi_events(spark, sf_dir))
    return ev.select("ts", "timestamp", "date", "event", "user_id")


def conditional_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue from the nested price for purchases."""
    ev = K.with_revenue(kpi_events(spark, sf_dir))
    return ev.select("ts", "event", F.col("props.price").alias("price"), "revenue")


def filter_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """negative and null revenue rows removed."""
    ev = K.prepared_events(kpi_events(spark, sf_dir))
    return ev.select("ts", "event", "user_id", "item_id", "revenue")


def removed_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before / after / removed, one scan."""
    return K.removed_by_filter(K.with_revenue(kpi_events(spark, sf_dir)))


def kept_rows_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept rows written, their counts observed by that job and set
    beside the rows read back."""
    out = scratch_path(spark, "kept_rows")
    counts = K.write_kept(K.with_revenue(kpi_events(spark, sf_dir)), out)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows_read_back")).select(
        *[F.lit(n).cast("long").alias(c) for c, n in counts.items()], "rows_read_back")


def _enriched_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "ts", "event", "user_id", "item_id", F.col("context.country").alias("country"),
        "category", "tags", "plan", "marketing_opt_in", "revenue",
    )


def broadcast_left_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both left joins; unknown items keep a null category."""
    ev, items, users = _inputs(spark, sf_dir)
    return _enriched_columns(K.enrich(K.prepared_events(ev), items, users))


def repartition_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same joins after hash-partitioning events by user_id."""
    ev, items, users = _inputs(spark, sf_dir)
    ev = L.hash_partition(K.prepared_events(ev), "user_id")
    return _enriched_columns(K.enrich(ev, items, users))


def kpi_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A5 without the window."""
    ev, items, users = _inputs(spark, sf_dir)
    return K.daily_kpi(ev, items, users, with_window=False)


def repartition_group_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: pre-shuffle by the group keys (incl. a nested field), then A5."""
    ev, items, users = _inputs(spark, sf_dir)
    enriched = K.enrich(K.prepared_events(ev), items, users)
    enriched = L.hash_partition(enriched, "date", F.col("context.country"), "category")
    return K.kpi_aggregate(enriched)


def conditional_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: purchases per date as a conditional count."""
    ev = K.prepared_events(kpi_events(spark, sf_dir))
    return ev.groupBy("date").agg(
        F.count(F.lit(1)).alias("events_total"),
        F.count(F.when(F.col("event") == "purchase", True)).alias("purchases"),
    )


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: exact distinct users per (date, country), as bitmaps."""
    ev = K.prepared_events(kpi_events(spark, sf_dir)).withColumn("country", F.col("context.country"))
    return K.distinct_from_bitmaps(K.user_bitmaps(ev, "date", "country"), "date", "country")


def distinct_users_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: exact distinct users per country over all days, merged from stored
    daily bitmaps without looking at an event again."""
    ev = K.prepared_events(kpi_events(spark, sf_dir)).withColumn("country", F.col("context.country"))
    out = scratch_path(spark, "user_bitmaps")
    K.user_bitmaps(ev, "date", "country").write.parquet(out)
    return K.distinct_from_bitmaps(spark.read.parquet(out), "country")


def daily_kpi_large_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as it runs where users exceed the broadcast bound."""
    return K.daily_kpi(*_inputs(spark, sf_dir), users_broadcast_bytes=0)


def bucketed_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and users stored in buckets by user, then joined without
    an exchange on either side."""
    ev, items, users = _inputs(spark, sf_dir)
    tag = uuid.uuid4().hex
    names = f"events_{tag}", f"users_{tag}"
    L.store_for_joins(K.prepared_events(ev), users.drop("country"), "user_id", "id", *names,
                      scratch_path(spark, "bucketed"), buckets=8)
    joined = L.join_stored(spark, *names, "user_id", "id")
    for name in names:  # the folders stay: the tables are external
        spark.sql(f"DROP TABLE {name}")
    items_side, _ = broadcast_if_bounded(items)
    return _enriched_columns(joined.join(items_side, "item_id", "left"))


def rolling_sum_7_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 alone over the daily groups."""
    return daily_kpi(spark, sf_dir).select("country", "category", "date", "revenue", "revenue_7d")


def rolling_sum_7_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with a calendar frame: revenue of the current and six preceding days."""
    kpi = K.with_rolling_revenue(K.daily_kpi(*_inputs(spark, sf_dir), with_window=False), days=7)
    return kpi.select("country", "category", "date", "revenue", "revenue_7d")


def rolling_sum_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 in segments of ten days, each with the six rows before it."""
    kpi = K.with_rolling_revenue(K.daily_kpi(*_inputs(spark, sf_dir), with_window=False), segment_days=10)
    return kpi.select("country", "category", "date", "revenue", "revenue_7d")


def kpi_sorted_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 20 rows by (date, country, category); Spark's null
    order for ascending keys (nulls first) is written out."""
    kpi = daily_kpi(spark, sf_dir)
    return kpi.orderBy(
        F.col("date").asc_nulls_first(), F.col("country").asc_nulls_first(),
        F.col("category").asc_nulls_first(),
    ).limit(20)


def _write_kpi(spark: SparkSession, sf_dir: str, one_file_per_date: bool) -> str:
    out = scratch_path(spark, "daily_kpi")
    write_partitioned(daily_kpi(spark, sf_dir), out, "date", one_file_per_partition=one_file_per_date)
    return out


def kpi_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + read back: the whole table from its date folders."""
    out = _write_kpi(spark, sf_dir, one_file_per_date=False)
    return spark.read.parquet(out)


def kpi_first_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List the date partitions, read the first one back with
    its partition column kept."""
    out = _write_kpi(spark, sf_dir, one_file_per_date=False)
    return read_partition(spark, out, "date", L.first_partition_value(spark, out, "date", "date"))


def kpi_single_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per date folder, then read back."""
    out = _write_kpi(spark, sf_dir, one_file_per_date=True)
    return spark.read.parquet(out)


def kpi_file_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per date folder after the one-file-per-date write."""
    out = _write_kpi(spark, sf_dir, one_file_per_date=True)
    return L.files_per_partition(spark.read.parquet(out), "date")


def kpi_layout_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI (an aggregated, small result) written as date folders
    and again as one file; rows, revenue, files and
    seconds of both, side by side (the clock is left out here)."""
    folders = spark.read.parquet(_write_kpi(spark, sf_dir, one_file_per_date=True))
    single = f"{scratch_path(spark, 'daily_kpi_one')}/table"
    L.coalesce_one(folders).write.parquet(single)
    return L.timed_layouts({"date_folders": folders, "one_file": spark.read.parquet(single)}, "revenue").drop("seconds")


def kpi_partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date partitions of the written table."""
    out = _write_kpi(spark, sf_dir, one_file_per_date=False)
    return L.list_partitions(spark, out, "date", "date")


def dataset_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per KPI input dataset, one result."""
    from weir.operators.quality import dataset_counts

    ev, items, users = _inputs(spark, sf_dir)
    return dataset_counts([("users", users), ("items", items), ("events", ev)])


def partition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each KPI input, summed from its records per Spark
    partition (which depend on the layout), and whether it has any."""
    out = None
    for name, df in zip(("events", "items", "users"), _inputs(spark, sf_dir)):
        r = L.partition_record_counts(df, name)
        out = r if out is None else out.unionByName(r)
    return out.groupBy("dataset").agg(
        F.sum("records").alias("records"), (F.count_distinct("partition") >= 1).alias("has_partitions"))



def item_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and revenue per item tag (explode of the items' tag
    array; events of unknown items have no tags and drop out)."""
    ev, items, users = _inputs(spark, sf_dir)
    enriched = K.enrich(K.prepared_events(ev), items, users)
    tags = enriched.select(F.explode("tags").alias("tag"), "revenue")
    return tags.groupBy("tag").agg(
        F.count(F.lit(1)).alias("events"), F.sum("revenue").cast(K.MONEY_SUM).alias("revenue")
    )
