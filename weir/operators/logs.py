"""Access logs and the users document formats: parse, count errors,
join log lines to users by IP, flatten the users document."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators.joins import broadcast_if_bounded
from weir.sources.datasets import LOG_TIME_FORMAT

# Fixed value: the combined log line plus the level / request / error tail.
LOG_PATTERN = (
    r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+) "([^"]*)" "([^"]*)"'
    r" level=(\S+) request_id=(\S+)(?: error_type=ERROR:(\S+))?$"
)
SEPARATOR = "\x01"
_FIELDS = ("ip", "time", "method", "target", "protocol", "status", "bytes", "referrer",
           "user_agent", "level", "request_id", "error_type")


def parse_access_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Typed columns from each line (regexp, JVM side).
    A line that does not match gives nulls (kept, not dropped), and so does a
    time, page or size that is none."""
    # one pass of the pattern: its groups, set apart by a character that lines do not hold
    joined = SEPARATOR.join(f"${i + 1}" for i in range(len(_FIELDS)))
    parts = F.split(F.regexp_replace(F.translate(F.col(col), SEPARATOR, ""), LOG_PATTERN, joined), SEPARATOR)
    rows = lines.select(parts.alias("parts"))
    held = {f: F.when(F.size("parts") == len(_FIELDS), F.col("parts")[i]) for i, f in enumerate(_FIELDS)}
    target = held["target"]
    return rows.select(
        held["ip"].alias("ip"),
        F.try_to_timestamp(held["time"], F.lit(LOG_TIME_FORMAT)).alias("ts"),
        held["method"].alias("method"),
        F.regexp_extract(target, r"^([^?]*)", 1).alias("path"),
        F.nullif(F.regexp_extract(target, r"[?&]page=([^&]*)", 1), F.lit("")).try_cast("int").alias("page"),
        held["status"].try_cast("int").alias("status"),
        held["bytes"].try_cast("long").alias("bytes"),
        held["user_agent"].alias("user_agent"),
        held["level"].alias("level"),
        held["request_id"].alias("request_id"),
        F.nullif(held["error_type"], F.lit("")).alias("error_type"),
    )


def error_counts(parsed: DataFrame) -> DataFrame:
    """ERROR lines counted by error_type and status."""
    return parsed.filter(F.col("level") == "ERROR").groupBy("error_type", "status").agg(
        F.count(F.lit(1)).alias("lines")
    )


def flatten_users(docs: DataFrame) -> DataFrame:
    """One row per user of each document, nested fields flattened."""
    return flatten_user_elements(docs.select(F.explode("users").alias("element")))


def flatten_user_elements(elements: DataFrame) -> DataFrame:
    """One row per user (column `element`), nested fields flattened."""
    u = F.col("element")
    return elements.select(
        u["id"].alias("id"),
        u["profile"]["name"].alias("name"),
        u["profile"]["username"].alias("username"),
        u["profile"]["ip"].alias("ip"),
        u["profile"]["tz"].alias("tz"),
        u["contact"]["email"].alias("email"),
        u["preferences"]["lang"].alias("lang"),
        u["preferences"]["marketing_opt_in"].alias("marketing_opt_in"),
        u["preferences"]["theme"].alias("theme"),
        F.size(u["devices"]).alias("devices"),
        F.array_join(u["tags"], ",").alias("tags"),
    )


def pack_user_documents(users: DataFrame, generated_at: str, source: str = "generator") -> DataFrame:
    """JSON users documents (column `value`), one per Arrow batch of users, so
    that a document is bounded whatever a partition holds. Each row is rendered
    by `to_json` in the JVM; Python only joins one batch's strings."""
    head = F"{{\"generated_at\": \"{generated_at}\", \"meta\": {{\"source\": \"{source}\", \"version\": 1}}, \"users\": ["
    rows = users.select(F.to_json(F.struct(*users.columns)).alias("j"))

    def pack(batches):
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": [head + ",".join(batch["j"]) + "]}"]})

    return rows.mapInPandas(pack, T.StructType([T.StructField("value", T.StringType())]))


def requests_per_user(parsed: DataFrame, users_flat: DataFrame) -> DataFrame:
    """Log lines LEFT JOIN users ON ip (users broadcast only when their
    measured size fits), then requests and errors per (ip, user)."""
    side, _ = broadcast_if_bounded(users_flat.select("ip", F.col("id").alias("user_id"), "username"))
    per_ip = parsed.groupBy("ip").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("level") == "ERROR").alias("errors")
    )
    return per_ip.join(side, "ip", "left").select("ip", "user_id", "username", "requests", "errors")
