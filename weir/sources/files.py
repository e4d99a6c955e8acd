"""File sources (S1-S6, S9-S12). Schema-first: a declared schema means no
inference pass over the data and stable types across files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.session import apply_result_conf


# S1 / S2 -------------------------------------------------------------------
def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               mode: str = "PERMISSIVE", repartition: int | None = None) -> DataFrame:
    """JSON lines (plain or .gz, file or folder) with a declared schema.

    A .gz file cannot be split, so a folder of N gz files is read by N
    tasks; `repartition` spreads the rows over more tasks afterwards.
    """
    apply_result_conf(spark)
    df = spark.read.schema(schema).option("mode", mode).json(path)
    return df.repartition(repartition) if repartition else df


# S3 ------------------------------------------------------------------------
def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Header CSV with inferred types. Inference is an extra pass over the
    input; `sampling_ratio` < 1 bounds it on large inputs."""
    return (
        spark.read.option("header", True).option("inferSchema", True)
        .option("samplingRatio", sampling_ratio).csv(path)
    )


# S4 ------------------------------------------------------------------------
def read_csv_declared(spark: SparkSession, path: str, schema: T.StructType,
                      fail_fast: bool = True) -> DataFrame:
    """COPY-like bulk load: declared columns, header skipped, a bad row
    aborts the load (FAILFAST)."""
    return (
        spark.read.schema(schema).option("header", True).option("sep", ",")
        .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


# S5 ------------------------------------------------------------------------
def read_partition(spark: SparkSession, root: str, col: str, value) -> DataFrame:
    """One partition folder, read so that the partition column is kept."""
    leaf = f"{root.rstrip('/')}/{col}={value}"
    return spark.read.option("basePath", root).parquet(leaf)


# S6 ------------------------------------------------------------------------
def read_parquet_with_lineage(spark: SparkSession, path: str,
                              ns_timestamp_cols: tuple[str, ...] = ()) -> DataFrame:
    """Parquet with `source_file` = basename of the file each row came from
    (or, for a landing laid out as `source_file=<name>/` folders, that
    partition value).

    INT64 TIMESTAMP(NANOS) columns are read as long nanoseconds (see
    `weir.session.RESULT_CONF`) and converted to microsecond timestamps.
    """
    apply_result_conf(spark)
    df = spark.read.parquet(path)
    for c in ns_timestamp_cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.LongType):
            df = df.withColumn(c, F.expr(f"timestamp_micros(`{c}` div 1000)"))
    if "source_file" in df.columns:
        return df
    return df.withColumn("source_file", F.col("_metadata.file_name"))


# S9 ------------------------------------------------------------------------


def read_documents_strict(spark: SparkSession, path: str, schema: T.StructType,
                          required: tuple[str, ...]) -> DataFrame:
    """JSON documents; a malformed document fails the read (FAILFAST) and a
    document lacking a required field fails the returned DataFrame's
    evaluation (`raise_error` - a data error, checked inside the tasks)."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    missing = None
    for c in required:
        cond = F.col(c).isNull()
        missing = cond if missing is None else (missing | cond)
    if missing is None:
        return df
    guard = F.when(missing, F.raise_error(F.lit("document lacks a required field")))
    return df.filter(guard.isNull())


# S10 -----------------------------------------------------------------------
def read_text_lines(spark: SparkSession, path: str, repartition: int | None = None) -> DataFrame:
    """Text lines (.gz allowed: one task per gz file, then optional spread)."""
    df = spark.read.text(path)
    return df.repartition(repartition) if repartition else df


# S11 -----------------------------------------------------------------------
def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-file JSON documents (multiLine). One task per file: a folder
    of many documents spreads, a single huge document does not; for that see
    `weir.sources.json_array`."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


# S12 -----------------------------------------------------------------------
def list_files(spark: SparkSession, path: str, glob: str = "*.parquet",
               recursive: bool = False) -> DataFrame:
    """Files in a landing folder (path, filename, parent folder, length,
    modified); file contents are not read (the binaryFile source only reads
    `content` when it is selected)."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.load(path)
    return df.select(
        F.col("path"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
        "length",
        F.col("modificationTime").alias("modified"),
    )
