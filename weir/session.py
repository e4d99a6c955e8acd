"""Session builder and the few session settings every job relies on.

The library never keeps global state of its own: everything a job needs is
either an argument or a Spark SQL setting on the session it is given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that decide *results* (not speed). Applied to any session a query
# receives, so a caller's session gives the same answers as ours.
RESULT_CONF = {
    # dates are derived from instants; pin the zone so a date never depends
    # on where the driver runs
    "spark.sql.session.timeZone": "UTC",
    # Parquet files with INT64 TIMESTAMP(NANOS) (the fuel export) are read as
    # long nanoseconds and converted with timestamp_micros(ns div 1000)
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# Settings that decide *speed* at scale. Only set by `build_session`; a
# cluster session keeps whatever its operator chose.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot key's shuffle partition instead of running it in one task
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # rebalance partitions before writes (date folders) when AQE can
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def apply_result_conf(spark: SparkSession) -> SparkSession:
    """Pin the settings that change answers, and make the package importable
    by Python workers. Cheap and idempotent."""
    for k, v in RESULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Zip this package once per application and add it with `addPyFile`,
    so Python workers on every executor can import it (UDF code is pickled
    by reference to its module)."""
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. Spark Connect)
        return
    if app in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="weir-pkg-")
    archive = shutil.make_archive(
        os.path.join(out, "weir"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="weir"
    )
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from `spark.checkpoint.dir` (the cluster names it). Only when it is
    unset on a local master (tests) a scratch folder is chosen and recorded
    on the session, so every later call sees the same place. On a cluster a
    folder of one machine would lose rows, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master or 'a cluster'}")
        d = tempfile.mkdtemp(prefix="weir-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. Spark Connect)
        pass
    return d


_SCRATCH: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Makes a folder that its file system removes when the driver's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint root, in a folder of this
    application that is removed when the application ends. Spark makes the
    folder when it writes, on whatever file system the root names."""
    root = checkpoint_root(spark).rstrip("/")
    try:
        root = f"{root}/weir-{spark.sparkContext.applicationId}"
        if root not in _SCRATCH:
            _remove_at_exit(spark, root)
            _SCRATCH.add(root)
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. Spark Connect): nothing is removed
        pass
    return f"{root}/{name}-{uuid.uuid4().hex}"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "weir",
    extra: dict | None = None,
) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass no master."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {**SCALE_CONF, **RESULT_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_result_conf(spark)
    return spark
