"""Plan shapes that carry the scale properties (read from explain())."""

import contextlib
import io

from pyspark.sql import functions as F


from weir.operators import ingest as I
from weir.operators.sinks import first_per_key
from weir.plans import kpi, sql_reports
from weir.sources import datasets as D
from weir.operators import kpi as K
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_kpi_small_dims_are_broadcast_and_scan_is_pruned(spark):
    p = plan(kpi.daily_kpi(spark, SF_SMALL))
    tree = p.split("\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftOuter") == 2 and "SortMergeJoin" not in p
    # events scan reads only the columns the KPI needs
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string," \
           "value:double,props:string>" in p


def test_kpi_large_users_preaggregates_before_the_join(spark):
    ev, items, users = D.kpi_events(spark, SF_SMALL), D.kpi_items(spark, SF_SMALL), D.kpi_users(spark, SF_SMALL)
    p = plan(K.daily_kpi(ev, items, users, users_broadcast_bytes=0))
    # partial aggregate of events happens before any exchange toward the join
    assert "partial_count" in p and "partial_sum" in p
    assert "BroadcastHashJoin" in p   # items still broadcast (measured small)


def test_first_wins_combines_map_side(spark):
    rows = D.fuel_rows(spark, SF_SMALL)
    p = plan(first_per_key(I.flatten_fuel(rows, with_load_time=False), "transaction_id", I.FIRST_WINS_ORDER))
    assert "partial_min" in p and "Window" not in p


def test_presence_uses_no_outer_join_on_swipes(spark):
    p = plan(sql_reports.outer_join_range_on(spark, SF_SMALL))
    assert "LeftOuter" not in p and "LeftAnti" in p
    assert "EqualTo(o_orderstatus,F)" in p   # session filter reaches the scan


def test_order_totals_partial_aggregation(spark):
    from weir.plans import orders

    p = plan(orders.order_totals(spark, SF_SMALL))
    assert "partial_sum" in p and "collect_list" not in p


def test_hot_key_left_join_is_split_by_aqe(spark):
    """A third of the fact rows on one key, no broadcast: AQE's skew join
    splits the hot partition of the streamed (left) side at run time."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
        dim = spark.range(30000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = fact.join(dim, "k", "left")
        assert len(joined.collect()) == 30000   # run this very plan, then read its final form
        p = plan(joined)
        assert "isSkewJoin=true" in p or "skew=true" in p.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_ingest_reads_stored_state_only(spark):
    """The driver tables are read once, for the landing; the load itself
    scans new landing folders and joins file names by broadcast."""
    from weir.plans import ingest

    p = plan(ingest.insert_if_absent(spark, SF_SMALL))
    assert "lineitem" not in p and "part.parquet" not in p
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


def test_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    from weir.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_new_files_prune_the_landing_by_a_join(spark):
    from weir.plans import ingest

    p = plan(ingest.flatten_nested_load(spark, SF_SMALL))
    pruned = [line for line in p.splitlines() if line.startswith("PartitionFilters:") and "source_file" in line]
    assert any("dynamicpruning" in line for line in pruned), p
