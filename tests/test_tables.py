"""Declared tables: rules, defaults, keyed loads and what they read."""

import pytest
from pyspark.sql import functions as F

from weir.operators import sinks
from weir.operators import tables as T

SPEC = T.TableSpec((
    T.TableColumn("k", "VARCHAR(8)", required=True), T.TableColumn("v", "INT", required=True),
    T.TableColumn("flag", "BOOLEAN", default="false"), T.TableColumn("at", "TIMESTAMP", default="current_timestamp()"),
), "k", buckets=4)


@pytest.fixture()
def table(spark, tmp):
    T.declare(spark, "weir_test_t", SPEC, f"{tmp}/t")
    yield "weir_test_t"
    spark.sql("DROP TABLE IF EXISTS weir_test_t")


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def _keys(spark, table):
    return sorted((r.k, r.v) for r in spark.table(table).collect())


def test_declared_once_and_defaults_filled(spark, tmp, table):
    T.insert(_df(spark, [("a", 1), ("b", 2)]), table, SPEC)
    T.declare(spark, table, SPEC, f"{tmp}/elsewhere")
    rows = spark.table(table).collect()
    assert len(rows) == 2 and all(r.flag is False and r["at"] is not None for r in rows)
    # a new session finds the same folder
    spark.sql(f"DROP TABLE {table}")
    T.declare(spark, table, SPEC, f"{tmp}/t")
    assert _keys(spark, table) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("bad, message", [([("123456789", 1)], "EXCEED_LIMIT_LENGTH"), ([("a", None)], "NOT NULL"),
                                          ([(None, 1)], "NOT NULL")])
def test_a_broken_rule_fails_the_whole_load(spark, table, bad, message):
    with pytest.raises(Exception, match=message):
        T.insert(_df(spark, [("ok", 1), *bad]), table, SPEC)
    assert spark.table(table).count() == 0


def test_lacking_required_column(spark, table):
    with pytest.raises(ValueError, match="v"):
        T.insert(spark.createDataFrame([("a",)], "k string"), table, SPEC)


def test_refused_rows_go_to_quarantine_with_their_rules(spark, tmp, table):
    rows = [("a", 1), ("123456789", 2), (None, None), ("b", 3)]
    assert T.insert_checked(_df(spark, rows), table, SPEC, f"{tmp}/q") == T.LoadCounts(4, 2)
    assert _keys(spark, table) == [("a", 1), ("b", 3)]
    got = {r.v: sorted(r.broken_rules) for r in spark.read.parquet(f"{tmp}/q").collect()}
    assert got == {2: ["max_length_8:k"], None: ["not_null:k", "not_null:v"]}
    assert T.insert_checked(_df(spark, [("c", 1)]), table, SPEC, f"{tmp}/none") == T.LoadCounts(1, 0)
    assert T.insert_checked(_df(spark, []), table, SPEC, f"{tmp}/none") == T.LoadCounts(0, 0)


@pytest.mark.parametrize("limit", [None, 0])
def test_load_inserts_absent_keys_once(spark, table, limit):
    T.insert(_df(spark, [(f"k{i:03}", i) for i in range(50)]), table, SPEC)
    load = _df(spark, [(f"k{i:03}", 1000 + j) for i in range(30, 70) for j in (2, 1)])
    assert T.load_absent(load, table, SPEC, ("v",), limit) == 20
    assert T.load_absent(load, table, SPEC, ("v",), limit) == 0
    assert _keys(spark, table) == sorted([(f"k{i:03}", i) for i in range(50)] + [(f"k{i:03}", 1001) for i in range(50, 70)])
    assert T.load_absent(_df(spark, []), table, SPEC, ("v",), limit) == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_load_moves_the_load_alone(spark, table):
    T.insert(_df(spark, [(f"k{i:03}", i) for i in range(50)]), table, SPEC)
    load = _df(spark, [(f"k{i:03}", i) for i in range(40, 60)])
    plan = _plan(sinks.rows_to_insert(load, spark.table(table), "k", ("v",), broadcast_max_bytes=0, buckets=4))
    scan = plan[plan.index("FileScan parquet"):]
    assert "GreaterThanOrEqual(k,k040)" in scan and "LessThanOrEqual(k,k059)" in scan and "Bucketed: true" in scan
    load_side, target_side = plan[plan.index("LeftAnti"):].split("\n   +- Sort", 1)
    assert "Exchange" not in target_side and "FileScan" in target_side
    # the load is reduced before it is dealt to the buckets
    assert load_side.index("REPARTITION_BY_NUM") < load_side.index("partial_min")


def _rows_read(df):
    """Rows that the scan handed out: those of row groups and pages that could not be skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_key_bounds_and_bloom_filters_skip_what_cannot_match(spark, tmp, table):
    for run in range(5):  # five loads of consecutive key ranges
        T.insert(_df(spark, [(f"k{run}{i:03}", i) for i in range(0, 400, 2)]), table, SPEC)
    whole = spark.table(table).select("k")
    assert whole.count() == 1000
    bounds = sinks.key_bounds(_df(spark, [("k3010", 0), ("k3390", 0)]), "k")
    assert (bounds.rows, bounds.low, bounds.high) == (2, "k3010", "k3390")
    assert 0 < _rows_read(whole.filter(F.col("k").between(bounds.low, bounds.high))) <= 200  # one load's files of five
    assert _rows_read(whole.filter(F.col("k").isin(["k3011", "k3013"]))) < 200  # within the range, in few buckets or none


def test_observing_leaves_the_session_fit_for_learners(spark, table):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    T.insert_checked(_df(spark, [("a", 1), ("b", 2)]), table, SPEC, "unused")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(40).selectExpr("cast(id as double) x", "cast(id % 2 as double) label"))
    RandomForestClassifier(numTrees=2, seed=1).fit(rows)


def test_buckets_grow_with_the_rows():
    assert SPEC.for_rows(0) == SPEC and SPEC.for_rows(4 * T.BUCKET_ROWS) == SPEC
    assert SPEC.for_rows(4 * T.BUCKET_ROWS + 1).buckets == 5
