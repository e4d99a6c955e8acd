"""JDBC source and sink for the manifest / target tables.

The reference keeps its target and manifest in PostgreSQL. These helpers
read a table (or only the columns a plan needs) and append rows. JDBC has
no ON CONFLICT, so insert-if-absent is the anti join of
`weir.operators.sinks.rows_to_insert` followed by a plain append: correct
with one writer at a time (the reference also runs one load at a time).

Not exercised here: no database may be started in this environment. The
Parquet-table form of the same tables is what the tests and keys use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, columns: tuple[str, ...] = (),
                    properties: dict | None = None, partition_column: str | None = None,
                    lower: int | None = None, upper: int | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """A table over JDBC; `columns` is pushed down as the SELECT list and a
    numeric `partition_column` splits the read over `num_partitions`
    concurrent queries."""
    source = f"(SELECT {', '.join(columns)} FROM {table}) AS t" if columns else table
    r = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()


def processed_file_names(spark: SparkSession, url: str, properties: dict | None = None,
                         table: str = "processed_files") -> DataFrame:
    """The manifest's file names only."""
    return read_jdbc_table(spark, url, table, ("filename",), properties)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 10_000) -> None:
    """Append rows in batches from every task in parallel."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()
