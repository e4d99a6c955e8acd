import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weir import schemas
from weir.operators import kpi as K
from weir.plans import kpi as plans
from weir.sources import datasets as D
from tests.conftest import SF_SMALL


def _events(spark, rows):
    # rows: (ts, event, user_id, item_id, country, price)
    data = [
        (ts, ev, uid, iid, (country, "web", "en_US", "s"), (price, None, None), ("A",))
        for ts, ev, uid, iid, country, price in rows
    ]
    return spark.createDataFrame(data, schemas.EVENTS)


def _items(spark):
    return spark.createDataFrame([(1, "books", ["new"]), (2, "toys", [])], schemas.ITEMS)


def _users(spark):
    return spark.createDataFrame([(10, None, "free", "DE", True), (11, None, "pro", "US", False)],
                                 schemas.USERS)


def test_revenue_filter_drops_negative_and_null_price(spark):
    ev = _events(spark, [
        ("2024-01-01T10:00:00+00:00", "purchase", 10, 1, "US", 5.0),
        ("2024-01-01T11:00:00+00:00", "purchase", 10, 1, "US", -3.0),
        ("2024-01-01T12:00:00+00:00", "purchase", 11, 1, "US", None),
        ("2024-01-01T13:00:00+00:00", "view", 11, 1, "US", None),
    ])
    counts = K.removed_by_filter(K.with_revenue(ev)).first()
    assert (counts.rows_before, counts.rows_after, counts.rows_removed) == (4, 2, 2)


def test_kpi_unknown_item_is_null_category_group(spark):
    ev = _events(spark, [
        ("2024-01-01T10:00:00+00:00", "purchase", 10, 1, "US", 5.5),
        ("2024-01-01T10:30:00+00:00", "view", 11, 99, "US", None),
        ("2024-01-01T11:00:00+00:00", "view", 10, 99, "US", None),
    ])
    out = {(r.category,): r for r in K.daily_kpi(ev, _items(spark), _users(spark)).collect()}
    assert out[("books",)].revenue == Decimal("5.50")
    assert out[("books",)].purchases == 1
    assert out[(None,)].events_total == 2 and out[(None,)].unique_users == 2


def test_rolling_window_counts_rows_not_days(spark):
    # one (country, category) with 8 active days spread over a gap
    days = [1, 2, 3, 4, 5, 6, 20, 21]
    ev = _events(spark, [
        (f"2024-01-{d:02d}T10:00:00+00:00", "purchase", 10, 1, "US", float(d)) for d in days
    ])
    rows = K.daily_kpi(ev, _items(spark), _users(spark)).orderBy("date").collect()
    # day 21 sums itself and the 6 preceding *rows* (days 3..20), not days 15..21
    assert rows[-1].date == dt.date(2024, 1, 21)
    assert rows[-1].revenue_7d == Decimal(sum([3, 4, 5, 6, 20, 21]) + 2)


def test_large_users_path_equals_broadcast_path(spark):
    ev, items, users = D.kpi_events(spark, SF_SMALL), D.kpi_items(spark, SF_SMALL), D.kpi_users(spark, SF_SMALL)
    a = K.daily_kpi(ev, items, users)
    b = K.daily_kpi(ev, items, users, users_broadcast_bytes=0)
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_duplicate_user_rows_multiply_like_a_left_join(spark):
    ev = _events(spark, [("2024-01-01T10:00:00+00:00", "purchase", 10, 1, "US", 2.0)])
    users = _users(spark).unionByName(_users(spark).filter("id = 10"))
    for limit in (1 << 30, 0):
        r = K.daily_kpi(ev, _items(spark), users, users_broadcast_bytes=limit).first()
        assert (r.events_total, r.purchases, r.revenue, r.unique_users) == (2, 2, Decimal("4.00"), 1)


def test_first_partition_keeps_partition_column(spark):
    df = plans.kpi_first_partition(spark, SF_SMALL)
    assert "date" in df.columns
    assert df.select("date").distinct().count() == 1


def test_one_file_per_date(spark):
    layout = plans.kpi_file_layout(spark, SF_SMALL)
    assert layout.agg(F.max("files")).first()[0] == 1


def test_unparsable_ts_gives_null_date_not_failure(spark):
    import pytest

    ev = _events(spark, [("not a time", "view", 10, 1, "US", None),
                         ("2024-01-01T10:00:00+00:00", "view", 10, 1, "US", None)])
    rows = K.with_time_columns(ev).select("timestamp", "date").collect()
    assert sorted((r.date is None) for r in rows) == [False, True]
    with pytest.raises(Exception):
        K.with_time_columns(ev, strict=True).collect()


def _daily(spark):
    """Groups with date gaps, null keys, null revenue and one dominant group."""
    import datetime as dt
    import random

    rng, start = random.Random(3), dt.date(2023, 12, 20)
    rows = []
    for country, category, days, share in (("N1", "a", 400, 1.0), ("N1", None, 90, 0.4), (None, "b", 60, 0.2), ("N2", "c", 40, 0.1),
                                           ("N3", "d", 1, 1.0)):
        for d in range(days):
            if rng.random() < share:
                revenue = None if rng.random() < 0.05 else Decimal(rng.randint(0, 9999)) / 100
                rows.append((start + dt.timedelta(days=d), country, category, revenue))
    return spark.createDataFrame(rows, "date date, country string, category string, revenue decimal(22,2)"), rows


def _rolled(rows, reach):
    out = set()
    for date, country, category, _ in rows:
        group = sorted((r for r in rows if r[1:3] == (country, category) and r[0] <= date), key=lambda r: r[0])
        near = group[-7:] if reach is None else [r for r in group if (date - r[0]).days < reach]
        sums = [r[3] for r in near if r[3] is not None]
        out.add((date, country, category, sum(sums) if sums else None))
    return out


@pytest.mark.parametrize("days", [None, 7])
@pytest.mark.parametrize("segment", [None, 7, 10, 45, 5000])
def test_rolling_frames_and_segments(spark, days, segment):
    df, rows = _daily(spark)
    got = K.with_rolling_revenue(df, days=days, segment_days=segment)
    assert got.columns == [*df.columns, "revenue_7d"]
    found = [(r.date, r.country, r.category, r.revenue_7d) for r in got.collect()]
    assert len(found) == len(rows) and set(found) == _rolled(rows, days)


def test_short_segments_carry_rows_over_several(spark):
    df, rows = _daily(spark)
    got = K.with_rolling_revenue(df, segment_days=2).collect()
    assert {(r.date, r.country, r.category, r.revenue_7d) for r in got} == _rolled(rows, None) and len(got) == len(rows)
    with pytest.raises(ValueError):
        K.with_rolling_revenue(df, days=7, segment_days=2)


def test_segments_split_a_dominant_group(spark):
    df, _ = _daily(spark)
    p = K.with_rolling_revenue(df, segment_days=10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(country" in p and "_segment" in p[p.index("hashpartitioning(country"):]


def test_bitmap_distinct_is_exact_and_merges(spark, tmp):
    ids = [None, 0, 1, -1, 5, 5, 32767, 32768, 32769, -32768, 65536, 2**40, -(2**40)]
    rows = [("d1", "x", i) for i in ids] + [("d2", "x", i) for i in ids[:6]] + [("d2", "y", None), ("d3", None, 7)]
    df = spark.createDataFrame(rows, "date string, country string, user_id long").repartition(5)
    maps = K.user_bitmaps(df, "date", "country")
    for keys in (("date", "country"), ("country",), ("date",), ()):
        want = {tuple(r[:-1]): r[-1] for r in df.groupBy(*keys).agg(F.countDistinct("user_id")).collect()}
        got = {tuple(r[:-1]): r[-1] for r in K.distinct_from_bitmaps(maps, *keys).collect()}
        assert got == want, keys
    shuffled = maps._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in shuffled  # combined before the exchange


@pytest.mark.parametrize("users", [[(1, "N1"), (2, "N2")], [(1, "N1"), (1, "N2"), (2, "N3"), (None, "N4")]])
def test_large_users_paths_agree(spark, users):
    from tests.conftest import SF_SMALL
    from weir.sources import datasets as D

    ev, items = D.kpi_events(spark, SF_SMALL), D.kpi_items(spark, SF_SMALL)
    u = spark.createDataFrame(users, "id long, country string")
    small = K.daily_kpi(ev, items, u).collect()
    large = K.daily_kpi(ev, items, u, users_broadcast_bytes=0)
    assert sorted(map(str, small)) == sorted(map(str, large.collect()))
    assert K.ids_are_unique(u) == (len(users) == 2)


def test_write_kept_observes_its_counts(spark, tmp):
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("-1.00"),), (None,)], "revenue decimal(12,2)")
    assert K.write_kept(df, f"{tmp}/k") == {"rows_before": 3, "rows_after": 1, "rows_removed": 2}
    assert spark.read.parquet(f"{tmp}/k").count() == 1
    assert K.write_kept(df.limit(0), f"{tmp}/e")["rows_before"] == 0
