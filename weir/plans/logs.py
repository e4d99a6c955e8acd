"""Access-log query keys: access log parse, error counts, users document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weir import schemas
from weir.operators import logs as G
from weir.session import scratch_path
from weir.sources import datasets as D
from weir.sources.files import read_text_lines
from weir.sources.json_array import read_array_elements

# Fixed value: the generated_at stamp of the users documents.
USERS_GENERATED_AT = "2024-01-01T00:00:00Z"


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "access_log")
    # one gz file per partition of the lines: gzip cannot be split, so the
    # read parallelism is the number of files, which grows with the input
    D.access_log_lines(spark, sf_dir).write.mode("overwrite").option("compression", "gzip").text(out)
    return G.parse_access_log(read_text_lines(spark, out))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "users_docs")
    G.pack_user_documents(D.user_documents_rows(spark, sf_dir), USERS_GENERATED_AT) \
        .write.mode("overwrite").text(out)
    return G.flatten_user_elements(read_array_elements(spark, out, "users", schemas.USER_DOC))


def parse_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gz log lines -> typed columns."""
    return _parsed(spark, sf_dir)


def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ERROR lines by error_type and status."""
    return G.error_counts(_parsed(spark, sf_dir))


def users_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users documents -> one row per user."""
    return _users(spark, sf_dir)


def log_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and errors per ip with the matching user."""
    return G.requests_per_user(_parsed(spark, sf_dir), _users(spark, sf_dir))
