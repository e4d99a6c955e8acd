"""Readers for the driver tables (one Parquet file or folder per table).

Only the columns a plan uses are read: every reader returns a lazy
DataFrame, so Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.session import apply_result_conf

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_result_conf(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread the rows over the cluster when a scan yields fewer partitions
    than there are cores (one small file or one row group is one task).
    Large inputs already have many splits and pass unchanged, so no shuffle
    is added at scale.

    Rows are hash-partitioned on their scan position
    (`monotonically_increasing_id`): even, content-independent (identical
    hot rows still spread), and reproduced exactly when a scan task is
    re-run - without the full sort a round-robin `repartition(n)` performs
    to stay deterministic."""
    try:
        n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (e.g. Spark Connect)
        return df
    return df.repartition(n, F.monotonically_increasing_id()) if current < n else df
