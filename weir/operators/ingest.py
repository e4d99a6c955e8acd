"""Incremental file ingestion into a keyed target table.

Per run: files not yet in the manifest are read; a file with a row that
breaks NOT NULL on the target is rejected whole (earlier and later files
still load); struct and array columns are flattened with defaults; rows are
inserted only if their key is absent (first row per key wins); every
loaded file gets a manifest entry with the rows *attempted* from it.

Everything is expressed as joins and grouped aggregates, so the step is
idempotent: re-running it (a replayed stream batch, a retried job) inserts
nothing twice, because both the target and the manifest are anti-joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.columns import empty_if_null, false_if_null
from weir.operators.joins import DEFAULT_MAX_BYTES, broadcast_if_bounded, measure_bounded
from weir.operators.sinks import KeyBounds, key_measures, manifest_append, rows_to_insert
from weir.schemas import FUEL_TARGET_KEY
from weir.session import checkpoint_root

# The columns that make "first row wins" a total order
# (file name first, then the row's own values).
FIRST_WINS_ORDER = (
    "source_file", "visited_at", "coords_x", "station_id", "fuel_units", "total_cost",
    "price_per_unit", "coords_y", "species", "fuel_type", "dock_bay", "dock_level",
)
NOT_NULL = ("transaction_id", "station_id")


def flatten_fuel(df: DataFrame, with_load_time: bool = True) -> DataFrame:
    """Dock struct -> dock_bay/dock_level (null struct gives
    nulls), null services -> [], null is_emergency -> false; prices stay
    decimal; `loaded_at` = load time."""
    out = df.select(
        "transaction_id", "station_id",
        F.col("dock.bay").alias("dock_bay"), F.col("dock.level").alias("dock_level"),
        "ship_name", "franchise", "captain_name", "species", "fuel_type",
        F.col("fuel_units").cast("float").alias("fuel_units"),
        F.col("price_per_unit").cast("decimal(8,2)").alias("price_per_unit"),
        F.col("total_cost").cast("decimal(12,2)").alias("total_cost"),
        empty_if_null("services").alias("services"),
        false_if_null("is_emergency").alias("is_emergency"),
        "visited_at", "arrival_date",
        F.col("coords_x").cast("double").alias("coords_x"),
        F.col("coords_y").cast("double").alias("coords_y"),
        "source_file",
    )
    return out.withColumn("loaded_at", F.current_timestamp()) if with_load_time else out


def unprocessed(rows: DataFrame, manifest: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Rows whose file is not in the manifest (anti join by
    basename; null-safe, unlike NOT IN). A manifest of a measured size is
    broadcast, so the rows are not shuffled by their few file names."""
    m, _ = broadcast_if_bounded(manifest.select(F.col("filename").alias(file_col)))
    return rows.join(m, on=file_col, how="left_anti")


def new_file_names(files: DataFrame, manifest: DataFrame, name_col: str = "filename") -> DataFrame:
    """S12 + J5: file names in the landing folder not yet in the manifest."""
    return files.select(name_col).distinct().join(
        manifest.select(F.col("filename").alias(name_col)), name_col, "left_anti"
    )


def only_new_files(rows: DataFrame, files: DataFrame, manifest: DataFrame, file_col: str = "source_file") -> DataFrame:
    """S12 + J5: the rows of the listed files that are not in the manifest.

    Listing and manifest are joined as data, and the rows are semi-joined with
    the names that remain. Where the rows lie in folders by file, Spark prunes
    the scan by those names at run time (dynamic partition pruning); none come
    to the driver. Files without bytes hold no rows."""
    names = new_file_names(files.filter(F.col("length") > 0), manifest).select(F.col("filename").alias(file_col))
    side, _ = broadcast_if_bounded(names)
    return rows.join(side, file_col, "left_semi")


def file_counts(rows: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Per file, in one pass over three columns: its rows, those that break NOT
    NULL (a file with any is rejected whole, as a per-file transaction would
    roll back), and the bounds of its keys."""
    bad = F.lit(False)
    for c in NOT_NULL:
        bad = bad | F.col(c).isNull()
    keys = [m.alias(f"key_{n}") for m, n in zip(key_measures(FUEL_TARGET_KEY), ("rows", "bytes", "low", "high"))]
    return rows.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows_loaded"), F.count_if(bad).alias("bad_rows"), *keys)


@dataclass
class FileStep:
    fresh: DataFrame          # rows of files that the manifest lacks
    files: DataFrame          # one stored row per such file: its counts and key bounds
    manifest_new: DataFrame   # manifest rows to append
    rejected: DataFrame       # files rejected whole (source_file, bad_rows)
    attempted: DataFrame      # rows attempted per file (A13)


def file_step(incoming: DataFrame, manifest: DataFrame) -> FileStep:
    """What a load run decides per file; the counts are taken once and stored."""
    checkpoint_root(incoming.sparkSession)
    fresh = unprocessed(incoming, manifest)
    files = file_counts(fresh).checkpoint()
    loaded = files.filter("bad_rows = 0")
    entries = loaded.select(F.col("source_file").alias("filename"), F.current_timestamp().alias("processed_at"),
                            "rows_loaded")
    return FileStep(fresh, files, manifest_append(manifest, entries),
                    files.filter("bad_rows > 0").select("source_file", "bad_rows"),
                    loaded.select("source_file", "rows_loaded"))


def accepted(step: FileStep) -> DataFrame:
    """The rows of the files that are not rejected whole. The names of the
    rejected ones are broadcast, so that no row moves for the few there are. They
    are stored, so measuring them is no scan, whatever their plan is estimated at."""
    refused = step.rejected.select("source_file")
    size = measure_bounded(refused, hopeless_bytes=1 << 63)
    if size is None or size.bytes > DEFAULT_MAX_BYTES:
        return step.fresh.join(refused, "source_file", "left_anti")
    return step.fresh.join(F.broadcast(refused), "source_file", "left_anti") if size.rows else step.fresh


@dataclass
class IngestStep:
    inserts: DataFrame        # rows to append to the target
    manifest_new: DataFrame   # manifest rows to append
    rejected: DataFrame       # files rejected whole (source_file, bad_rows)
    attempted: DataFrame      # rows attempted per file (A13)


def ingest_step(incoming: DataFrame, target: DataFrame, manifest: DataFrame) -> IngestStep:
    """One load run over export rows (`source_file` set per row): the files'
    step, then the rows of the files it accepts, minus keys the target has. The
    size and bounds of the keys come from the files' stored counts."""
    step = file_step(incoming, manifest)
    total = step.files.agg(
        F.sum("key_rows").alias("rows"), F.sum("key_bytes").alias("bytes"),
        F.min("key_low").alias("low"), F.max("key_high").alias("high")).first()
    good = accepted(step)
    bounds = KeyBounds(total["rows"] or 0, total["bytes"] or 0, total["low"], total["high"])
    inserts = rows_to_insert(flatten_fuel(good, with_load_time=False), target, FUEL_TARGET_KEY, FIRST_WINS_ORDER, bounds)
    return IngestStep(inserts.withColumn("loaded_at", F.current_timestamp()), step.manifest_new, step.rejected, step.attempted)
