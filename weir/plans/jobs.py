"""Jobs over the reference's own input files (what a user runs day to day).

Each job reads files in the reference's formats with declared schemas,
runs the same operators as the query keys, and writes or returns the
result. Command line:

    python -m weir.plans.jobs kpi --users U --items I --events E --out O
    python -m weir.plans.jobs presence --data DIR
    python -m weir.plans.jobs ingest --landing L --target T --manifest M --checkpoint C [--archive A]
    python -m weir.plans.jobs stream --topic T --out O --checkpoint C [--brokers B] [--max-records N] [--builtin-avro]
    python -m weir.plans.jobs orders --docs D --out O
    python -m weir.plans.jobs logs --logs L --users U
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schemas
from weir.operators import kpi as K
from weir.operators import logs as G
from weir.operators.sinks import write_ordered_csv, write_partitioned
from weir.plans.sql_reports import run_alibi_sql
from weir.session import apply_result_conf
from weir.sources.files import (
    read_csv_declared,
    read_documents_strict,
    read_jsonl,
    read_text_lines,
)
from weir.sources.json_array import read_array_elements
from weir.streaming import events as S
from weir.streaming.file_ingest import run_file_ingest

# Fixed values of the reference's presence investigation.
PRESENCE = dict(
    session="S3", start="2025-09-01 13:00:00", end="2025-09-01 13:15:00",
    late="2025-09-01 13:10:00", product="Coffee", since="2025-09-01 15:00:00", min_count=3,
)
STREAM_TOPIC = "events"  # default topic name; pass --topic for yours


def kpi_job(spark: SparkSession, users: str, items: str, events: str, out: str | None = None,
            one_file_per_date: bool = False, spread_to: int | None = None) -> DataFrame:
    """Daily KPI from users.jsonl, items.jsonl and a folder of gz event
    files; written date-partitioned when `out` is given. Gzip files are
    one task each, so `spread_to` spreads the events after the read."""
    apply_result_conf(spark)
    u = read_jsonl(spark, users, schemas.USERS)
    i = read_jsonl(spark, items, schemas.ITEMS)
    e = read_jsonl(spark, events, schemas.EVENTS, repartition=spread_to)
    kpi = K.daily_kpi(e, i, u)
    if out:
        write_partitioned(kpi, out, "date", one_file_per_partition=one_file_per_date)
    return kpi


def presence_job(spark: SparkSession, data_dir: str, **params) -> DataFrame:
    """The investigation over people.csv, sessions.csv, swipes.csv and
    purchases.csv (header, comma, declared columns, FAILFAST)."""
    apply_result_conf(spark)
    d = data_dir.rstrip("/")
    people = read_csv_declared(spark, f"{d}/people.csv", schemas.PEOPLE)
    swipes = read_csv_declared(spark, f"{d}/swipes.csv", schemas.SWIPES)
    purchases = read_csv_declared(spark, f"{d}/purchases.csv", schemas.PURCHASES)
    return run_alibi_sql(spark, people, swipes, purchases, **{**PRESENCE, **params})


def presence_table_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows loaded per table (the COPY counts), one result."""
    d = data_dir.rstrip("/")
    out = None
    for name, schema in (("people", schemas.PEOPLE), ("sessions", schemas.SESSIONS),
                         ("swipes", schemas.SWIPES), ("purchases", schemas.PURCHASES)):
        c = read_csv_declared(spark, f"{d}/{name}.csv", schema).agg(F.count(F.lit(1)).alias("row_count"))
        c = c.select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionAll(c)
    return out


def ingest_job(spark: SparkSession, landing: str, target: str, manifest: str, checkpoint: str,
               archive: str | None = None):
    """New fuel export files (ns timestamps) -> keyed target + manifest."""
    return run_file_ingest(spark, landing, target, manifest, checkpoint, archive_dir=archive)


def stream_job(spark: SparkSession, out: str, checkpoint: str, topic: str = STREAM_TOPIC,
               brokers: str | None = None, builtin_avro: bool = False,
               max_records: int = S.MAX_RECORDS_PER_TRIGGER, raw: DataFrame | None = None) -> None:
    """Kafka topic of Avro events -> Parquet per micro-batch; runs until
    stopped (T9). `raw` takes envelopes from another stream than the topic."""
    apply_result_conf(spark)
    if raw is None:
        raw = S.kafka_source(spark, topic, brokers, records=max_records)
    S.start_stream(S.decode_envelopes(raw, builtin_avro), out, checkpoint).awaitTermination()


def orders_job(spark: SparkSession, docs: str, out: str) -> DataFrame:
    """Order documents (JSON) -> the 9 CSV fields, in order_id order."""
    read = read_documents_strict(spark, docs, schemas.ORDER, schemas.ORDER_CSV_FIELDS)
    rows = read.select(*schemas.ORDER_CSV_FIELDS)
    write_ordered_csv(rows, out, ["order_id"])
    return rows


def logs_job(spark: SparkSession, logs: str, users_doc: str, spread_to: int | None = None):
    """gz access logs + users document -> (error counts, requests per user)."""
    apply_result_conf(spark)
    parsed = G.parse_access_log(read_text_lines(spark, logs, repartition=spread_to))
    users = G.flatten_user_elements(read_array_elements(spark, users_doc, "users", schemas.USER_DOC))
    return G.error_counts(parsed), G.requests_per_user(parsed, users)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="weir.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    k = sub.add_parser("kpi")
    for a in ("--users", "--items", "--events", "--out"):
        k.add_argument(a, required=True)
    k.add_argument("--one-file-per-date", action="store_true")
    p = sub.add_parser("presence")
    p.add_argument("--data", required=True)
    i = sub.add_parser("ingest")
    for a in ("--landing", "--target", "--manifest", "--checkpoint"):
        i.add_argument(a, required=True)
    i.add_argument("--archive")
    s = sub.add_parser("stream")
    for a in ("--out", "--checkpoint"):
        s.add_argument(a, required=True)
    s.add_argument("--topic", default=STREAM_TOPIC)
    s.add_argument("--brokers")
    s.add_argument("--max-records", type=int, default=S.MAX_RECORDS_PER_TRIGGER)
    s.add_argument("--builtin-avro", action="store_true", help="from_avro; needs the spark-avro package")
    o = sub.add_parser("orders")
    for a in ("--docs", "--out"):
        o.add_argument(a, required=True)
    g = sub.add_parser("logs")
    for a in ("--logs", "--users"):
        g.add_argument(a, required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"weir-{args.job}").getOrCreate()
    if args.job == "kpi":
        kpi_job(spark, args.users, args.items, args.events, args.out, args.one_file_per_date)
    elif args.job == "presence":
        presence_job(spark, args.data).show(truncate=False)
    elif args.job == "ingest":
        ingest_job(spark, args.landing, args.target, args.manifest, args.checkpoint, args.archive)
    elif args.job == "stream":
        stream_job(spark, args.out, args.checkpoint, args.topic, args.brokers, args.builtin_avro, args.max_records)
    elif args.job == "orders":
        orders_job(spark, args.docs, args.out)
    elif args.job == "logs":
        errors, per_user = logs_job(spark, args.logs, args.users)
        errors.show(truncate=False)
        per_user.show(truncate=False)


if __name__ == "__main__":
    main()
