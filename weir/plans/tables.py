"""Declared-table query keys: loads into catalog tables with rules and defaults."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import ingest as I
from weir.operators import tables as T
from weir.plans.ingest import accepted_rows, stored_state
from weir.schemas import FUEL_TARGET, FUEL_TARGET_KEY, FUEL_TARGET_RULES
from weir.session import scratch_path
from weir.sources import datasets as D

_RULES = {name: (length, required) for name, length, required in FUEL_TARGET_RULES}
_DEFAULTS = {"is_emergency": "false", "loaded_at": "current_timestamp()"}


def _fuel_column(name: str, kind: str) -> T.TableColumn:
    length, required = _RULES.get(name, (None, False))
    return T.TableColumn(name, f"VARCHAR({length})" if length else kind, required, _DEFAULTS.get(name))


FUEL_TABLE = T.TableSpec(
    tuple(_fuel_column(f.name, f.dataType.simpleString()) for f in FUEL_TARGET.fields), FUEL_TARGET_KEY, buckets=8)

# The longest product text a purchase may have here; longer ones are refused.
PURCHASES_TABLE = T.TableSpec((
    T.TableColumn("purchase_id", "BIGINT", required=True), T.TableColumn("badge_uid", "VARCHAR(32)", required=True),
    T.TableColumn("location", "VARCHAR(100)"), T.TableColumn("product", "VARCHAR(10)"),
    T.TableColumn("qty", "INT", default="1"), T.TableColumn("ts", "TIMESTAMP_NTZ"),
), "purchase_id", buckets=8)


def _loaded(spark: SparkSession, sf_dir: str, broadcast_max_bytes: int | None) -> DataFrame:
    """The earlier run's rows, then the new files' rows whose key is absent, in a
    freshly declared table; read back from its folder."""
    s = stored_state(spark, sf_dir)
    spec = FUEL_TABLE.for_rows(s.rows.count())
    table, location = f"fuel_{uuid.uuid4().hex}", f"{scratch_path(spark, 'fuel-table')}/rows"
    T.declare(spark, table, spec, location)
    T.insert(s.target.drop("loaded_at"), table, spec)
    T.declare(spark, table, spec, location)  # there already: nothing changes
    T.load_absent(accepted_rows(spark, s), table, spec, I.FIRST_WINS_ORDER, broadcast_max_bytes)
    spark.sql(f"DROP TABLE {table}")  # the folder stays: the table is external
    return spark.read.schema(FUEL_TARGET).parquet(location)


def declared_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with VARCHAR(n), NOT NULL and DEFAULT columns, its load
    time filled in by the table itself."""
    return _loaded(spark, sf_dir, None).withColumn("stamped", F.col("loaded_at").isNotNull()).drop("loaded_at")


def bucketed_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, J6 beyond the broadcast bound: the load is dealt to the target's
    buckets and the target is not moved."""
    return _loaded(spark, sf_dir, 0).drop("loaded_at")


def quarantine_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 at the sink: rows in the table, and rows in quarantine per broken rule;
    the observed counts of the load beside them."""
    table, root = f"purchases_{uuid.uuid4().hex}", scratch_path(spark, "purchases-table")
    T.declare(spark, table, PURCHASES_TABLE, f"{root}/rows")
    incoming = D.lab_purchases(spark, sf_dir).drop("qty")
    counts = T.insert_checked(incoming, table, PURCHASES_TABLE, f"{root}/quarantine")
    spark.sql(f"DROP TABLE {table}")
    loaded = spark.read.parquet(f"{root}/rows")
    out = loaded.agg(F.count("qty").alias("rows")).select(F.lit("table").alias("place"), F.lit("").alias("rule"), "rows")
    if counts.refused:
        out = out.union(spark.read.parquet(f"{root}/quarantine").select(F.explode("broken_rules").alias("rule")).groupBy(
            "rule").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("quarantine"), "rule", "rows"))
    observed = spark.createDataFrame([("observed", "rows", counts.rows), ("observed", "refused", counts.refused)], out.schema)
    return out.union(observed)
