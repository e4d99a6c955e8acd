import datetime as dt

from weir import schemas
from weir.operators import presence as P
from weir.plans import sql_reports as R


def _ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def _lab_rows(spark):
    # hand-written rows in the shape of the presence tables
    people = spark.createDataFrame([
        (1, "Ada Nguyen", "Gamma", "B-1"),
        (2, "Juno Garcia", "Alpha", "B-2"),
        (3, "Bo Park", "Beta", "B-3"),
        (4, "Dina Ali", "Gamma", "B-4"),
    ], schemas.PEOPLE)
    swipes = spark.createDataFrame([
        ("B-1", "S3", _ts("2025-09-01 13:01:00")),   # on time: alibi
        ("B-2", "S3", _ts("2025-09-01 13:13:32")),   # late
        ("B-4", "S1", _ts("2025-09-01 13:05:00")),   # other session: no alibi
    ], schemas.SWIPES)
    rows = [
        (1, "B-2", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:11:32")),
        (2, "B-2", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:40:00")),
        (3, "B-2", "cafeteria", "Coffee", 1, _ts("2025-09-01 16:20:00")),
        (4, "B-1", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:20:00")),
        (5, "B-1", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:30:00")),
        (6, "B-1", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:50:00")),
        (7, "B-4", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:10:00")),
        (8, "B-4", "cafeteria", "Coffee", 1, _ts("2025-09-01 15:15:00")),
        (9, "B-4", "cafeteria", "Coffee", 1, _ts("2025-09-01 14:00:00")),
    ]
    purchases = spark.createDataFrame(rows, schemas.PURCHASES)
    return people, swipes, purchases


LAB = dict(session="S3", start="2025-09-01 13:00:00", end="2025-09-01 13:15:00",
           late="2025-09-01 13:10:00", product="Coffee", since="2025-09-01 15:00:00", min_count=3)
# Golden value from the lab's README: md5 of the thief's normalized name.
GOLDEN_HASH = "a047207351d4bac07bb6b1a5d944d060"


def test_golden_thief_sql(spark):
    people, swipes, purchases = _lab_rows(spark)
    rows = R.run_alibi_sql(spark, people, swipes, purchases, **LAB).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.thief_name == "Juno Garcia" and r.verification_hash == GOLDEN_HASH
    assert r.coffees_bought_after_15h == 3
    assert r.late_arrival_to_session == _ts("2025-09-01 13:13:32")


def test_golden_thief_dataframe_form(spark):
    people, swipes, purchases = _lab_rows(spark)
    from pyspark.sql import functions as F

    nt = lambda v: F.lit(v).cast("timestamp_ntz")
    s = P.absent_or_late(people, swipes, "S3", nt(LAB["start"]), nt(LAB["end"]), nt(LAB["late"]))
    got = {(r.badge_uid, r.arrival_time) for r in s.collect()}
    # absent people keep a null arrival (conditions are in ON, not WHERE)
    assert got == {("B-2", _ts("2025-09-01 13:13:32")), ("B-3", None), ("B-4", None)}
    b = P.repeat_buyers(purchases, "Coffee", nt(LAB["since"]), 3)
    rows = P.late_and_jittery(s, b).collect()
    assert [r.verification_hash for r in rows] == [GOLDEN_HASH]


def test_csv_demo_sample(spark, tmp):
    # the five-row people CSV of the demo, inferred types
    path = f"{tmp}/people.csv"
    with open(path, "w") as f:
        f.write("id,name,age,city\n1,Alice,28,New York\n2,Bob,35,San Francisco\n"
                "3,Charlie,42,Chicago\n4,Diana,31,Boston\n5,Eve,26,Seattle\n")
    from pyspark.sql import functions as F

    from weir.sources.files import read_csv_inferred

    df = read_csv_inferred(spark, path)
    assert dict(df.dtypes)["age"] == "int"
    assert sorted(r.name for r in df.filter(F.col("age") > 30).collect()) == ["Bob", "Charlie", "Diana"]
    assert df.agg(F.format_number(F.avg("age"), 1)).first()[0] == "32.4"


def test_constraint_violations_counts(spark):
    from weir.operators.quality import constraint_violations

    df = spark.createDataFrame(
        [(1, "a" * 12, "x"), (1, "b", None), (2, None, "y"), (None, "c", "z")],
        "k int, name string, code string",
    )
    got = {(r.rule, r.column_name): r.violations for r in
           constraint_violations(df, (("k", None, True), ("name", 10, False), ("code", None, True)),
                                 unique=("k",)).collect()}
    assert got == {("not_null", "k"): 1, ("max_length_10", "name"): 1, ("not_null", "code"): 1,
                   ("unique", "k"): 1}
