"""Declared target tables in the catalog (K8, P14), keyed loads into them (K5,
J6) and refusal of rows that break a declared rule (V1).

A table is declared once, with VARCHAR(n), NOT NULL and DEFAULT columns, over a
folder that outlives the session; declaring it again changes nothing. Lengths are
refused by Spark when a row is written. NOT NULL is a declaration only for Parquet
tables, so every load checks it here, inside its own tasks.

The rows of a table lie in buckets by the hash of its key, sorted by it, with a
Parquet bloom filter on it. A load is dealt to the same buckets, so an anti join
against a target of any size moves the load alone; the scan of the target's keys
carries the load's key bounds, and row groups of other key ranges are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators.sinks import observed, rows_to_insert


BUCKET_ROWS = 1_000_000  # rows of a bucket that a writing task sorts in its memory


@dataclass(frozen=True)
class TableColumn:
    name: str
    kind: str                   # SQL type; VARCHAR(n) is a rule
    required: bool = False      # NOT NULL
    default: str | None = None  # SQL expression the table fills in

    @property
    def max_length(self) -> int | None:
        kind = self.kind.upper()
        return int(kind[8:-1]) if kind.startswith("VARCHAR(") else None


@dataclass(frozen=True)
class TableSpec:
    columns: tuple[TableColumn, ...]
    key: str
    buckets: int = 64  # so that a bucket's rows fit a task at the size the table is to reach

    def for_rows(self, rows: int) -> TableSpec:
        """This table declared for that many rows: more buckets where they would
        hold more than `BUCKET_ROWS` each, never fewer than it names."""
        return replace(self, buckets=max(self.buckets, math.ceil(rows / BUCKET_ROWS)))

    def given(self, df: DataFrame) -> list[str]:
        """The declared columns that `df` brings, in table order. A required
        column that is neither brought nor filled in is an error."""
        lacking = [c.name for c in self.columns if c.required and c.default is None and c.name not in df.columns]
        if lacking:
            raise ValueError(f"required columns missing: {', '.join(lacking)}")
        return [c.name for c in self.columns if c.name in df.columns]


def declare(spark: SparkSession, table: str, spec: TableSpec, location: str) -> None:
    """K8: the table, unless it is there already."""
    columns = ", ".join(
        f"`{c.name}` {c.kind}" + (" NOT NULL" if c.required else "") + (f" DEFAULT {c.default}" if c.default else "")
        for c in spec.columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"OPTIONS ('parquet.bloom.filter.enabled#{spec.key}' 'true') "
        f"CLUSTERED BY (`{spec.key}`) SORTED BY (`{spec.key}`) INTO {spec.buckets} BUCKETS LOCATION '{location}'")


def broken_rules(df: DataFrame, spec: TableSpec) -> Column:
    """V1: the names of the rules a row breaks (`not_null:c`, `max_length_n:c`)."""
    checks = []
    for c in spec.columns:
        if c.name in df.columns and c.required:
            checks.append(F.when(F.col(c.name).isNull(), F.lit(f"not_null:{c.name}")))
        if c.name in df.columns and c.max_length is not None:
            checks.append(F.when(F.char_length(c.name) > c.max_length, F.lit(f"max_length_{c.max_length}:{c.name}")))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def insert(df: DataFrame, table: str, spec: TableSpec) -> DataFrame:
    """Appends rows and returns the statement's result, which holds what `df`
    observed; columns that `df` lacks take the table's defaults. A row that
    breaks NOT NULL or a length fails the load before anything of it is seen."""
    given = spec.given(df)
    absent = [F.col(c.name).isNull() for c in spec.columns if c.required and c.name in given]
    for missing in absent:
        df = df.filter(F.when(missing, F.raise_error(F.lit(f"{table}: null in a NOT NULL column"))).isNull())
    rows = df.select(*given).repartition(spec.buckets, spec.key)
    names = ", ".join(f"`{c}`" for c in given)
    return df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {{rows}}", rows=rows)


@dataclass(frozen=True)
class LoadCounts:
    rows: int
    refused: int


def insert_checked(df: DataFrame, table: str, spec: TableSpec, quarantine: str) -> LoadCounts:
    """V1 at the sink: rows that break a rule go to the quarantine folder with the
    names of their rules, the others into the table. Both counts are observed by
    the inserting job itself; without a refused row there is no second job."""
    checked = df.withColumn("broken_rules", broken_rules(df, spec))
    counted = checked.observe("load", F.count(F.lit(1)).alias("rows"), F.count_if(F.size("broken_rules") > 0).alias("refused"))
    found = observed(insert(counted.filter(F.size("broken_rules") == 0).drop("broken_rules"), table, spec), "load")
    counts = LoadCounts(found.get("rows", 0), found.get("refused", 0))
    if counts.refused:
        checked.filter(F.size("broken_rules") > 0).withColumn("refused_at", F.current_timestamp()) \
            .write.mode("append").parquet(quarantine)
    return counts


def load_absent(incoming: DataFrame, table: str, spec: TableSpec, order_by: Sequence[str],
                broadcast_max_bytes: int | None = None) -> int:
    """K5: inserts the rows whose key the table lacks, the first per key in
    `order_by`; the number of rows inserted is observed by the insert."""
    target = incoming.sparkSession.table(table)
    new = rows_to_insert(incoming, target, spec.key, order_by, broadcast_max_bytes=broadcast_max_bytes, buckets=spec.buckets)
    done = insert(new.observe("load", F.count(F.lit(1)).alias("inserted")), table, spec)
    return observed(done, "load").get("inserted", 0)
