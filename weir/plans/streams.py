"""Stream query keys: payload decode, micro-batch stream, file ingest.

Streams run with `availableNow` over files written from the driver tables
to a fresh folder under the checkpoint root, then the sink is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.plans.ingest import stored_state
from weir.session import scratch_path
from weir.sources import datasets as D
from weir.streaming import events as S
from weir.streaming.file_ingest import run_file_ingest

# Rate bound of the stream: bytes of envelope files per trigger.
ENVELOPE_BYTES_PER_TRIGGER = 64 << 20


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes decoded in one pass (batch form)."""
    return S.with_event_time(S.decode_envelopes(D.stream_envelopes(spark, sf_dir)))


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-fed stream, one folder per batch; the rows
    read back (batch_id / ingest_ts are run-dependent and left out)."""
    root = scratch_path(spark, "stream")
    landing, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    D.stream_envelopes(spark, sf_dir).write.parquet(landing)
    src = S.envelope_file_source(spark, landing, ENVELOPE_BYTES_PER_TRIGGER)
    q = S.start_stream(S.decode_envelopes(src), out, ckpt, available_now=True)
    q.awaitTermination()
    return S.with_event_time(spark.read.parquet(out).drop("batch_id", "ingest_ts"))


def file_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export files streamed into the keyed target (processed files
    archived by the source); the target read back (load time left out)."""
    # one folder per export (possibly several part files); all new files go
    # into one trigger, so an export is never split across batches
    s = stored_state(spark, sf_dir)
    root = scratch_path(spark, "ingest")
    run_file_ingest(spark, s.landing, s.target_path, s.manifest_path, f"{root}/checkpoint",
                    partitioned_by_file=True, visited_at_ns=False, archive_dir=f"{root}/archive")
    return spark.read.parquet(s.target_path).drop("loaded_at")
