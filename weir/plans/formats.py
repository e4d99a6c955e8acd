"""Source/sink round trips: CSV (inferred and declared), gz JSON lines.

Each key writes rows Spark derives from the driver tables to a fresh
folder under the session's checkpoint root, reads them back with the
reader under test, and returns what was read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schemas
from weir.operators.sinks import write_ordered_csv
from weir.session import scratch_path
from weir.sources import datasets as D
from weir.sources.files import read_csv_declared, read_csv_inferred, read_jsonl


def csv_inferred_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: header CSV read back with inferred types (id int, age int)."""
    out = scratch_path(spark, "people_csv")
    D.sample_people(spark, sf_dir).write.mode("overwrite").option("header", True).csv(out)
    return read_csv_inferred(spark, out)


def csv_declared_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + K4: purchases as header CSV in purchase_id order, loaded back
    into declared columns with FAILFAST (a bad row aborts the load)."""
    out = scratch_path(spark, "purchases_csv")
    rows = D.lab_purchases(spark, sf_dir)
    write_ordered_csv(rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
                      out, ["purchase_id"])
    return read_csv_declared(spark, out, schemas.PURCHASES)


def jsonl_gz_nested_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: nested events as gzipped JSON lines (several files), read
    back with the declared nested schema; nested fields selected by path."""
    out = scratch_path(spark, "events_jsonl")
    D.kpi_events(spark, sf_dir).write.mode("overwrite").option("compression", "gzip").json(out)
    ev = read_jsonl(spark, out, schemas.EVENTS)
    return ev.select(
        "ts", "event", "user_id", "item_id",
        F.col("context.country").alias("country"), F.col("context.device").alias("device"),
        F.col("props.price").alias("price"), F.col("props.payment_method").alias("payment_method"),
        F.col("props.dwell_ms").alias("dwell_ms"), F.col("exp.ab_group").alias("ab_group"),
    )
