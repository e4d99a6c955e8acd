"""New export files -> keyed target table, each file once.

The reference polls a folder every minute and loads all new files, row by
row. Here one trigger takes all new files (or `max_files_per_trigger`).
Here the file stream source finds new files (its checkpoint remembers what
it has seen) and each micro-batch runs `weir.operators.ingest.ingest_step`
against the current target and manifest, then appends. Because the step
anti-joins both, a replayed batch inserts nothing twice.

With the folder-per-export layout (`partitioned_by_file`), the manifest
records exports, not part files: keep `max_files_per_trigger` unset (all new
files in one trigger) so that an export is never split across batches.

With `archive_dir`, the files a batch has loaded are moved there once target
and manifest hold them; a file that is skipped (its name was in the manifest) or
rejected stays, and a move that fails is logged and changes nothing else. The
manifest, not the folder, is the record of what was loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators.ingest import ingest_step
from weir.operators.sinks import MANIFEST_SCHEMA, create_table_if_absent
from weir.schemas import FUEL_EXPORT, FUEL_TARGET
from weir.session import apply_result_conf
from weir.streaming.archive import move_files


def export_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                  partitioned_by_file: bool = False, visited_at_ns: bool = True) -> DataFrame:
    """Export rows with `source_file`: the file's basename, or - when the
    landing is laid out as `source_file=<name>/` folders - that name.

    The exporter writes `visited_at` as INT64 TIMESTAMP(NANOS), which Spark
    reads only as long nanoseconds (`nanosAsLong`); it is converted to a
    microsecond timestamp here. `visited_at_ns=False` for files whose
    timestamps are already micros (Spark-written)."""
    apply_result_conf(spark)
    schema = FUEL_EXPORT
    if visited_at_ns:
        schema = T.StructType([
            T.StructField(f.name, T.LongType()) if f.name == "visited_at" else f for f in schema.fields
        ])
    if partitioned_by_file:
        schema = T.StructType(schema.fields + [T.StructField("source_file", T.StringType())])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(landing)
    if visited_at_ns:
        df = df.withColumn("visited_at", F.expr("timestamp_micros(visited_at div 1000)"))
    if not partitioned_by_file:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def load_batch(spark: SparkSession, target_path: str, manifest_path: str, landing: str | None = None,
               archive_dir: str | None = None, partitioned_by_file: bool = False):
    def run(batch: DataFrame, batch_id: int) -> None:
        # the batch is a scan of stored files: each pass reads only its columns, so nothing is cached
        target = spark.read.schema(FUEL_TARGET).parquet(target_path)
        manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path)
        step = ingest_step(batch, target, manifest)
        step.inserts.select(*FUEL_TARGET.fieldNames()).write.mode("append").parquet(target_path)
        step.manifest_new.write.mode("append").parquet(manifest_path)
        if archive_dir:
            folder = "source_file=" if partitioned_by_file else ""
            loaded = (folder + r["source_file"] for r in step.attempted.toLocalIterator())
            move_files(spark, loaded, landing, archive_dir)

    return run


def run_file_ingest(spark: SparkSession, landing: str, target_path: str, manifest_path: str,
                    checkpoint: str, max_files_per_trigger: int | None = None,
                    archive_dir: str | None = None, partitioned_by_file: bool = False,
                    visited_at_ns: bool = True, available_now: bool = True):
    """Start (and, with `available_now`, finish) the ingest stream."""
    create_table_if_absent(spark, target_path, FUEL_TARGET)
    create_table_if_absent(spark, manifest_path, MANIFEST_SCHEMA)
    src = export_stream(spark, landing, max_files_per_trigger, partitioned_by_file, visited_at_ns)
    load = load_batch(spark, target_path, manifest_path, landing, archive_dir, partitioned_by_file)
    w = src.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
