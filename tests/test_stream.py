import pytest
from pyspark.sql import functions as F

from weir.functions import avro
from weir.schemas import ENVELOPE
from weir.streaming import events as S


def test_codec_round_trip_python():
    for rec in [("u_1", "click", 12.5, 1704067200123), ("", "é", -0.0, -1), ("x" * 300, "v", 1e300, 2**62)]:
        assert avro.decode_record(avro.encode_record(*rec)) == rec


def test_truncated_payload_is_rejected():
    buf = avro.encode_record("u_1", "view", 1.0, 5)
    with pytest.raises(avro.CorruptPayload):
        avro.decode_record(buf[:-3])


def test_udf_round_trip_with_null_payload(spark):
    src = spark.createDataFrame(
        [("u_1", "click", 1.25, 1000), ("u_2", "view", 2.5, 2000), (None, "view", 3.0, 3000)],
        "user string, event string, amount double, ts long",
    )
    enc = src.select(avro.encode_payload(F.col("user"), F.col("event"), F.col("amount"), F.col("ts")).alias("value"))
    dec = enc.select(avro.decode_payload(F.col("value")).alias("p")).collect()
    got = sorted([tuple(r.p) if r.p is not None else None for r in dec], key=str)
    assert None in got
    assert ("u_1", "click", 1.25, 1000) in got and ("u_2", "view", 2.5, 2000) in got


def test_corrupt_payload_fails_the_task(spark):
    bad = spark.createDataFrame([(b"\x02a\x80",)], "value binary")
    with pytest.raises(Exception):
        bad.select(avro.decode_payload(F.col("value")).alias("p")).collect()


def _envelopes(spark, n, start=0):
    rows = [
        (None, avro.encode_record(f"u_{i}", "view", float(i), 1000 * i), "demo", i % 3, i // 3, None)
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def test_stream_writes_one_folder_per_batch(spark, tmp):
    landing, out, ckpt = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ckpt"
    _envelopes(spark, 30).repartition(3).write.parquet(landing)
    q = S.start_stream(S.decode_envelopes(S.envelope_file_source(spark, landing, max_files_per_trigger=1)), out, ckpt, available_now=True)
    q.awaitTermination()
    res = spark.read.parquet(out)
    assert res.count() == 30
    assert res.select("batch_id").distinct().count() == 3   # maxFilesPerTrigger = 1
    # restart from the checkpoint: nothing is read twice
    q = S.start_stream(S.decode_envelopes(S.envelope_file_source(spark, landing, max_files_per_trigger=1)), out, ckpt, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 30


def test_batches_are_bounded_by_bytes_whatever_the_file_sizes(spark, tmp):
    import glob
    import os

    landing, out, ckpt = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ckpt"
    for i, n in enumerate((2000, 10, 10, 4000, 10, 500, 10, 10)):  # one file each
        _envelopes(spark, n, start=10_000 * i).coalesce(1).write.mode("append").parquet(landing)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{landing}/*.parquet")]
    bound = max(sizes) + 2 * min(sizes)
    src = S.envelope_file_source(spark, landing, bound)
    S.start_stream(S.decode_envelopes(src), out, ckpt, available_now=True).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 6550
    batches = rows.select("batch_id").distinct().count()
    assert sum(sizes) / bound <= batches < len(sizes)
    # no batch holds more than the bound: the two large files are in different ones
    large = {r.batch_id for r in rows.filter("user in ('u_0', 'u_30000')").collect()}
    assert len(large) == 2
    # a bound below every file still takes one file a batch
    S.start_stream(S.decode_envelopes(S.envelope_file_source(spark, landing, 1)), f"{tmp}/out1", f"{tmp}/ckpt1",
                   available_now=True).awaitTermination()
    assert spark.read.parquet(f"{tmp}/out1").select("batch_id").distinct().count() == len(sizes)


def test_replayed_batch_replaces_its_folder(spark, tmp):
    out = f"{tmp}/out"
    write = S.batch_writer(out)
    batch = S.decode_envelopes(_envelopes(spark, 10))
    write(batch, 0)
    write(S.decode_envelopes(_envelopes(spark, 5, start=10)), 1)
    write(batch, 0)   # replay of batch 0 after a failure
    res = spark.read.parquet(out)
    assert res.count() == 15
    assert res.filter("batch_id = 0").count() == 10


def test_odd_payloads():
    ends = [("", "", 0.0, 2**63 - 1), ("a", "é" * 200, float("inf"), -2**63), ("x" * 9000, "", -1.5, 0)]
    got = avro.decode_columns(avro.pa.array([avro.encode_record(*r) for r in ends], "large_binary"))
    assert list(zip(got[0].to_pylist(), got[1].to_pylist(), got[2].tolist(), got[3].tolist())) == ends
    assert len(avro.decode_columns(avro.pa.array([], "large_binary"))[0]) == 0
    good = avro.encode_record("u", "v", 1.0, 5)
    for bad in (b"", good + b"\x00", good[:-1] + b"\x80" * 11, b"\xff" * 9 + b"\x7f" + good, b"\x02\xff" + good[2:]):
        with pytest.raises(ValueError):
            avro.decode_record(bad)


def test_stream_job_runs_until_stopped(spark, tmp):
    """Default trigger; files that come while it runs are taken too."""
    import threading
    import time

    from weir.plans.jobs import stream_job

    landing, out, ckpt = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ckpt"
    _envelopes(spark, 20).write.parquet(landing)
    raw = S.envelope_file_source(spark, landing)
    running = threading.Thread(target=stream_job, args=(spark, out, ckpt), kwargs={"raw": raw}, daemon=True)
    running.start()

    def rows(n):
        for _ in range(240):
            try:
                if spark.read.parquet(out).count() == n:
                    return True
            except Exception:  # noqa: BLE001 - nothing written yet, or a folder being replaced
                pass
            time.sleep(0.25)
        return False

    assert rows(20) and running.is_alive()
    _envelopes(spark, 15, start=100).write.mode("append").parquet(landing)
    assert rows(35) and running.is_alive()
    for q in spark.streams.active:
        q.stop()
    running.join(60)
    assert not running.is_alive()
