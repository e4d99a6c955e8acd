import datetime as dt
import os
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq

from weir import schemas
from weir.operators import ingest as I
from weir.operators.sinks import MANIFEST_SCHEMA, first_per_key, rows_to_insert
from weir.sources.files import read_parquet_with_lineage
from weir.streaming.file_ingest import run_file_ingest

UTC = dt.timezone.utc


def _row(tid, station=1, dock=(1, "A"), services=("fuel",), emergency=True, src="f1.parquet",
         visited=dt.datetime(2024, 1, 1, tzinfo=UTC), units=1.0):
    return (tid, station, None if dock is None else {"bay": dock[0], "level": dock[1]}, "ship", "fr",
            "cap", "sp", "diesel", units, Decimal("1.50"), Decimal("10.00"),
            None if services is None else list(services), emergency, visited,
            dt.date(2024, 1, 1), 0.5, 0.25, src)


_ARROW = pa.schema([
    ("transaction_id", pa.string()), ("station_id", pa.int32()),
    ("dock", pa.struct([("bay", pa.int16()), ("level", pa.string())])),
    ("ship_name", pa.string()), ("franchise", pa.string()), ("captain_name", pa.string()),
    ("species", pa.string()), ("fuel_type", pa.string()), ("fuel_units", pa.float32()),
    ("price_per_unit", pa.decimal128(8, 2)), ("total_cost", pa.decimal128(12, 2)),
    ("services", pa.list_(pa.string())), ("is_emergency", pa.bool_()),
    ("visited_at", pa.timestamp("ns", tz="UTC")), ("arrival_date", pa.date32()),
    ("coords_x", pa.float64()), ("coords_y", pa.float64()),
])


def _write_export(path, rows):
    names = _ARROW.names
    cols = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    pq.write_table(pa.table(cols, schema=_ARROW), path, compression="snappy")


def _df(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType(schemas.FUEL_EXPORT.fields + [T.StructField("source_file", T.StringType())])
    return spark.createDataFrame(rows, schema)


def _empty_target(spark):
    return spark.createDataFrame([], schemas.FUEL_TARGET)


def _empty_manifest(spark):
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def test_flatten_defaults(spark):
    flat = I.flatten_fuel(_df(spark, [_row("a", dock=None, services=None, emergency=None)])).first()
    assert flat.dock_bay is None and flat.dock_level is None
    assert flat.services == [] and flat.is_emergency is False
    assert flat.price_per_unit == Decimal("1.50") and flat.loaded_at is not None


def test_first_row_wins_and_existing_kept(spark):
    incoming = _df(spark, [
        _row("k1", station=2, src="f2.parquet"),
        _row("k1", station=1, src="f1.parquet"),   # first by file name
        _row("k2", station=5, src="f1.parquet"),
    ])
    target = I.flatten_fuel(_df(spark, [_row("k2", station=9, src="old.parquet")]))
    step = I.ingest_step(incoming, target, _empty_manifest(spark))
    got = {r.transaction_id: (r.station_id, r.source_file) for r in step.inserts.collect()}
    assert got == {"k1": (1, "f1.parquet")}   # k2 exists already: kept, not replaced
    attempted = {r.source_file: r.rows_loaded for r in step.attempted.collect()}
    assert attempted == {"f1.parquet": 2, "f2.parquet": 1}   # attempts, conflicts included


def test_hot_key_first_wins_is_deterministic(spark):
    rows = [_row("hot", station=s, src="f.parquet") for s in range(500, 0, -1)]
    out = first_per_key(I.flatten_fuel(_df(spark, rows), with_load_time=False).repartition(7),
                        "transaction_id", I.FIRST_WINS_ORDER).collect()
    assert len(out) == 1 and out[0].station_id == 1


def test_manifest_skips_loaded_file_and_rejects_bad_file_whole(spark):
    incoming = _df(spark, [
        _row("a", src="done.parquet"),
        _row("b", src="bad.parquet"), _row("c", station=None, src="bad.parquet"),
        _row("d", src="good.parquet"),
    ])
    manifest = spark.createDataFrame([("done.parquet", None, 1)], MANIFEST_SCHEMA)
    step = I.ingest_step(incoming, _empty_target(spark), manifest)
    assert {r.transaction_id for r in step.inserts.collect()} == {"d"}
    assert {r.source_file for r in step.rejected.collect()} == {"bad.parquet"}
    assert {r.filename for r in step.manifest_new.collect()} == {"good.parquet"}


def test_rerun_is_idempotent(spark):
    incoming = _df(spark, [_row("a"), _row("b")])
    target, manifest = _empty_target(spark), _empty_manifest(spark)
    s1 = I.ingest_step(incoming, target, manifest)
    target = target.unionByName(s1.inserts.select(*target.columns))
    manifest = manifest.unionByName(s1.manifest_new)
    s2 = I.ingest_step(incoming, target, manifest)
    assert s2.inserts.count() == 0 and s2.manifest_new.count() == 0
    # even without the manifest, the target's keys stop duplicates
    s3 = I.ingest_step(incoming, target, _empty_manifest(spark))
    assert s3.inserts.count() == 0


def test_ns_timestamp_parquet_and_lineage(spark, tmp):
    _write_export(os.path.join(tmp, "fuel_export_1.parquet"), [_row("x")[:-1]])
    df = read_parquet_with_lineage(spark, tmp, ns_timestamp_cols=("visited_at",))
    r = df.first()
    assert r.source_file == "fuel_export_1.parquet"
    assert dict(df.dtypes)["visited_at"] == "timestamp"
    assert r.visited_at == dt.datetime(2024, 1, 1)   # UTC session, naive in Python


def test_file_stream_ingest_loads_each_file_once(spark, tmp):
    landing, archive = f"{tmp}/landing", f"{tmp}/archive"
    os.makedirs(landing)
    _write_export(f"{landing}/fuel_export_1.parquet", [_row("a")[:-1], _row("b")[:-1]])
    _write_export(f"{landing}/fuel_export_2.parquet", [_row("b")[:-1], _row("c")[:-1]])
    target, manifest, ckpt = f"{tmp}/target", f"{tmp}/manifest", f"{tmp}/ckpt"
    run_file_ingest(spark, landing, target, manifest, ckpt, archive_dir=archive)
    assert sorted(r.transaction_id for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]
    m = {r.filename: r.rows_loaded for r in spark.read.parquet(manifest).collect()}
    assert m == {"fuel_export_1.parquet": 2, "fuel_export_2.parquet": 2}
    t = spark.read.parquet(target).first()
    assert t.visited_at == dt.datetime(2024, 1, 1) and t.loaded_at is not None
    assert sorted(f for f in os.listdir(archive) if f.endswith(".parquet")) == ["fuel_export_1.parquet", "fuel_export_2.parquet"]
    assert not [f for f in os.listdir(landing) if f.endswith(".parquet")]
    # a second run finds nothing new
    run_file_ingest(spark, landing, target, manifest, ckpt, archive_dir=archive)
    assert spark.read.parquet(target).count() == 3


def test_archive_moves_what_was_loaded_and_logs_what_it_cannot(spark, tmp, caplog):
    landing, archive = f"{tmp}/landing", f"{tmp}/archive"
    os.makedirs(landing)
    os.makedirs(archive)
    for name, row in (("good", _row("a")), ("blocked", _row("b")), ("bad", _row("c", station=None)), ("seen", _row("d"))):
        _write_export(f"{landing}/{name}.parquet", [row[:-1]])
    with open(f"{archive}/blocked.parquet", "w") as f:
        f.write("an earlier file of that name")
    target, manifest, ckpt = f"{tmp}/target", f"{tmp}/manifest", f"{tmp}/ckpt"
    spark.createDataFrame([("seen.parquet", None, 1)], MANIFEST_SCHEMA).write.parquet(manifest)
    run_file_ingest(spark, landing, target, manifest, ckpt, archive_dir=archive)
    assert sorted(r.transaction_id for r in spark.read.parquet(target).collect()) == ["a", "b"]
    left = sorted(f for f in os.listdir(landing) if f.endswith(".parquet"))
    assert left == ["bad.parquet", "blocked.parquet", "seen.parquet"]  # not loaded, not movable, loaded before
    assert os.path.exists(f"{archive}/good.parquet")
    assert open(f"{archive}/blocked.parquet").read().startswith("an earlier")
    assert "blocked.parquet stays" in caplog.text and "good" not in caplog.text


def test_rows_to_insert_null_key_never_matches(spark):
    t = _empty_target(spark)
    inc = I.flatten_fuel(_df(spark, [_row(None)]), with_load_time=False)
    assert rows_to_insert(inc, t, "transaction_id", I.FIRST_WINS_ORDER).count() == 1


def test_insert_paths_agree(spark):
    """Broadcast-keys path and plain anti-join path give the same rows."""
    incoming = I.flatten_fuel(_df(spark, [
        _row("k1", station=3, src="f2.parquet"), _row("k1", station=1, src="f1.parquet"),
        _row("k2", station=5), _row("k3", station=7), _row(None, station=8),
    ]), with_load_time=False)
    target = I.flatten_fuel(_df(spark, [_row("k2", station=9, src="old.parquet")]), with_load_time=False)
    a = rows_to_insert(incoming, target, "transaction_id", I.FIRST_WINS_ORDER)
    b = rows_to_insert(incoming, target, "transaction_id", I.FIRST_WINS_ORDER, broadcast_max_bytes=0)
    got_a = sorted(((r.transaction_id, r.station_id) for r in a.collect()), key=repr)
    assert got_a == sorted(((r.transaction_id, r.station_id) for r in b.collect()), key=repr)
    assert sorted(got_a, key=repr) == sorted([("k1", 1), ("k3", 7), (None, 8)], key=repr)


def test_ns_timestamps_keep_every_microsecond(spark, tmp):

    import pyarrow as pa
    import pyarrow.parquet as pq
    from weir.sources.files import read_parquet_with_lineage

    base = 1_726_000_000_123_457
    micros = [base + 7919 * i for i in range(3000)]
    pq.write_table(pa.table({"t": pa.array([m * 1000 for m in micros], pa.timestamp("ns"))}), f"{tmp}/ns.parquet",
                   version="2.6")
    rows = read_parquet_with_lineage(spark, f"{tmp}/ns.parquet", ("t",)).selectExpr("unix_micros(t) AS u").collect()
    assert sorted(r.u for r in rows) == micros


def test_export_stream_by_folder_reads_ns(spark, tmp):
    from weir.streaming.file_ingest import export_stream

    schema = export_stream(spark, tmp, partitioned_by_file=True).schema
    assert schema["visited_at"].dataType.simpleString() == "timestamp" and "source_file" in schema.names


def test_accepted_rows_are_not_moved_to_leave_out_a_rejected_file(spark):
    fresh = _df(spark, [_row("b", src="bad.parquet"), _row("c", station=None, src="bad.parquet"),
                        _row("d", src="good.parquet")])
    step = I.file_step(fresh, _empty_manifest(spark))
    good = I.accepted(I.FileStep(fresh, step.files, step.manifest_new, step.rejected, step.attempted))
    assert [r.transaction_id for r in good.collect()] == ["d"]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_the_landing_is_written_without_a_sort(spark, tmp, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from weir.operators.sinks import OPEN_WRITERS, write_partitioned

    name, seen, plain = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a: (seen.append(spark.conf.get(name, None)), plain(w, *a))[1])
    before = spark.conf.get(name, None)
    # more folders than a task keeps open: the rows of the others are written all the same
    write_partitioned(spark.range(400).selectExpr("id", "id % 20 as f").coalesce(1), f"{tmp}/few", "f", few_values=True)
    assert seen == [str(OPEN_WRITERS)] and spark.conf.get(name, None) == before
    back = spark.read.parquet(f"{tmp}/few")
    assert sorted((r.id, r.f) for r in back.collect()) == [(i, i % 20) for i in range(400)]
    write_partitioned(spark.range(4).selectExpr("id", "id % 2 as f"), f"{tmp}/many", "f")
    assert seen[1] == before
