"""Order-client query keys: order documents, totals, validation, fetch outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schemas
from weir.operators import orders as O
from weir.operators.quality import uniqueness
from weir.operators.sinks import write_ordered_csv
from weir.session import scratch_path
from weir.sources import datasets as D
from weir.sources.files import read_csv_declared, read_documents_strict

ORDER_CSV_SCHEMA = "order_id long, account_id long, company string, status string, currency string, " \
    "subtotal double, tax double, total double, created_at string"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.with_amount(D.order_lines(spark, sf_dir))


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtotal, tax, total per order in decimal."""
    return O.order_totals(_lines(spark, sf_dir), D.order_states(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Order documents with their lines, as gzipped JSON (a file is as small
    as a write task, so its not being splittable costs no parallelism)."""
    docs = O.order_documents(D.order_headers(spark, sf_dir), _lines(spark, sf_dir))
    docs.select(
        "order_id", "account_id", "company", "contact", "status", "currency", "lines",
        *[F.col(c).cast("double").alias(c) for c in ("subtotal", "tax", "total")],
        "created_at", "source",
    ).write.mode("overwrite").option("compression", "gzip").json(folder)


def order_totals_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read back strictly (a malformed one or a missing
    field fails); the totals computed anew from their nested lines."""
    folder = f"{scratch_path(spark, 'orders')}/docs"
    _documents(spark, sf_dir, folder)
    read = read_documents_strict(spark, folder, schemas.ORDER, (*schemas.ORDER_CSV_FIELDS, "lines"))
    return O.order_totals_nested(read)


def order_fields_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents as JSON -> strict read of the 9 CSV fields
    (of the lines only that they are there) -> CSV in order_id order
    (range-partitioned parts) -> loaded back."""
    root = scratch_path(spark, "orders")
    _documents(spark, sf_dir, f"{root}/docs")
    read = read_documents_strict(spark, f"{root}/docs", schemas.ORDER_HEAD, (*schemas.ORDER_CSV_FIELDS, "lines"))
    write_ordered_csv(read.select(*schemas.ORDER_CSV_FIELDS), f"{root}/csv", ["order_id"])
    return read_csv_declared(spark, f"{root}/csv", ORDER_CSV_SCHEMA)


def order_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: valid / rejected with the failed rule names."""
    return O.validate_orders(D.order_states(spark, sf_dir), _lines(spark, sf_dir))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.fetch_outcomes(D.fetch_attempts(spark, sf_dir), D.FETCH_MAX_ATTEMPTS)


def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """outcome and attempts used per item."""
    return _outcomes(spark, sf_dir)


def fetched_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: the successfully fetched items."""
    return O.fetched_only(_outcomes(spark, sf_dir)).select("item_id", "attempts")


def fetch_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched rows vs distinct ids."""
    return uniqueness(O.fetched_only(_outcomes(spark, sf_dir)), "item_id")
