"""File-ingestion query keys: incremental load of fuel exports into a keyed table.

State at the start of the run, derived from the driver tables: the landing
holds four export files; `fuel_export_0.parquet` was loaded by an earlier
run (it is in the manifest and its rows are in the target).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import ingest as I
from weir.operators import quality as Q
from weir.operators.sinks import MANIFEST_SCHEMA, first_per_key, write_partitioned
from weir.schemas import FUEL_TARGET, FUEL_TARGET_KEY, FUEL_TARGET_RULES
from weir.session import scratch_path
from weir.sources import datasets as D
from weir.sources.files import list_files, read_parquet_with_lineage

# Fixed value: the time the earlier run is recorded with.
EARLIER_RUN_AT = "2000-01-01 00:00:00"


@dataclass(frozen=True)
class Stored:
    """What an ingestion run finds: landing folders, target and manifest, each
    written once; the target only where a query asks for it."""
    landing: str
    target_path: str
    manifest_path: str
    rows: DataFrame       # the landing read back, one partition value per export
    target: DataFrame | None
    manifest: DataFrame


def write_landing(rows: DataFrame, landing: str) -> None:
    """The export files on disk, one `source_file=<name>/` folder per export
    (Spark cannot name its output files). Written without a shuffle or sort: each
    task adds a part file to the few folders it has rows for; the folder,
    not the part file, is the unit the manifest records."""
    write_partitioned(rows, landing, "source_file", few_values=True)


def stored_state(spark: SparkSession, sf_dir: str, with_target: bool = True) -> Stored:
    """The driver tables are read once, for the landing. The earlier run's
    target and manifest are loaded from its landing folders alone."""
    root = scratch_path(spark, "ingest-state")
    landing, target, manifest = f"{root}/landing", f"{root}/target", f"{root}/manifest"
    write_landing(D.fuel_rows(spark, sf_dir), landing)
    rows = read_parquet_with_lineage(spark, landing, ("visited_at",))
    before = rows.filter(F.col("source_file").isin(*D.FUEL_LOADED_BEFORE))
    if with_target:
        first = first_per_key(I.flatten_fuel(before, with_load_time=False), FUEL_TARGET_KEY, I.FIRST_WINS_ORDER)
        first.withColumn("loaded_at", F.lit(EARLIER_RUN_AT).cast("timestamp")) \
            .select(*FUEL_TARGET.fieldNames()).write.parquet(target)
    before.groupBy(F.col("source_file").alias("filename")).agg(
        F.lit(EARLIER_RUN_AT).cast("timestamp").alias("processed_at"), F.count(F.lit(1)).alias("rows_loaded"),
    ).write.parquet(manifest)
    return Stored(landing, target, manifest, rows,
                  spark.read.schema(FUEL_TARGET).parquet(target) if with_target else None,
                  spark.read.schema(MANIFEST_SCHEMA).parquet(manifest))


def _listed(spark: SparkSession, s: Stored) -> DataFrame:
    """Exports in the landing, by folder name (no contents are read)."""
    listed = list_files(spark, s.landing, recursive=True)
    return listed.select(F.regexp_extract("folder", r"^source_file=(.+)$", 1).alias("filename"), "length")


def _new_rows(spark: SparkSession, s: Stored) -> DataFrame:
    """S12 then S6: the new folders' rows, the others pruned."""
    return I.only_new_files(s.rows, _listed(spark, s), s.manifest)


def _file_step(spark: SparkSession, sf_dir: str) -> tuple[Stored, I.FileStep]:
    s = stored_state(spark, sf_dir, with_target=False)
    return s, I.file_step(_new_rows(spark, s), s.manifest)


def accepted_rows(spark: SparkSession, s: Stored) -> DataFrame:
    """The new files' flattened rows, without files that are rejected whole."""
    step = I.file_step(_new_rows(spark, s), s.manifest)
    return I.flatten_fuel(I.accepted(step), with_load_time=False)


def _run(spark: SparkSession, sf_dir: str) -> tuple[Stored, I.IngestStep]:
    s = stored_state(spark, sf_dir)
    return s, I.ingest_step(_new_rows(spark, s), s.target, s.manifest)


def _final_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, step = _run(spark, sf_dir)
    return s.target.drop("loaded_at").unionByName(step.inserts.drop("loaded_at"))


def flatten_nested_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export files read back with their lineage,
    new files only, flattened (load time left out: it is the clock)."""
    s = stored_state(spark, sf_dir, with_target=False)
    return I.flatten_fuel(_new_rows(spark, s), with_load_time=False)


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after the run."""
    return _final_target(spark, sf_dir)


def new_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed in the landing folder (by export name)
    that are not in the manifest."""
    s = stored_state(spark, sf_dir, with_target=False)
    return I.new_file_names(_listed(spark, s), s.manifest)


def manifest_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the manifest after the run (filename, rows_loaded)."""
    s, step = _file_step(spark, sf_dir)
    return s.manifest.unionByName(step.manifest_new).select("filename", "rows_loaded")


def rows_loaded_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows attempted per loaded file (conflicts included)."""
    return _file_step(spark, sf_dir)[1].attempted


def top10_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: ten newest transactions (transaction_id breaks visit-time ties,
    so the ten are well defined)."""
    t = _final_target(spark, sf_dir)
    return t.select("transaction_id", "ship_name", "franchise", "fuel_type", "total_cost", "visited_at") \
        .orderBy(F.col("visited_at").desc_nulls_first(), F.col("transaction_id").asc()).limit(10)


def revenue_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions and revenue per franchise, by revenue desc."""
    t = _final_target(spark, sf_dir)
    return t.groupBy("franchise").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("total_cost").cast("decimal(22,2)").alias("total_revenue"),
    ).orderBy(F.col("total_revenue").desc_nulls_first())


def manifest_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, newest first."""
    s, step = _file_step(spark, sf_dir)
    m = s.manifest.unionByName(step.manifest_new)
    return m.orderBy(F.col("processed_at").desc_nulls_first()).select("filename", "rows_loaded")


def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: violations of the target's UNIQUE / NOT NULL / VARCHAR(n) rules
    among all exported rows, before loading."""
    flat = I.flatten_fuel(D.fuel_rows(spark, sf_dir), with_load_time=False)
    return Q.constraint_violations(flat, FUEL_TARGET_RULES, unique=(FUEL_TARGET_KEY,))


def service_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions per service (explode of `services`) in the loaded
    target, and how many carry service 'F' (array_contains). The target is
    first counted per distinct list, so both figures come from one pass over
    it and few rows are exploded."""
    lists = _final_target(spark, sf_dir).groupBy("services").agg(F.count(F.lit(1)).alias("n"))
    lists = lists.checkpoint()  # one row per distinct list; else each branch below scans the target anew
    per_service = lists.select(F.explode("services").alias("service"), "n").groupBy("service").agg(
        F.sum("n").alias("transactions")
    )
    with_f = lists.filter(F.array_contains("services", "F")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("transactions")
    ).select(F.lit("has:F").alias("service"), "transactions")
    return per_service.unionByName(with_f)
