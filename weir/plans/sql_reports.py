"""SQL-style investigations and reports (presence investigation, CSV demo).

Constants of the presence investigation, re-aimed onto the driver tables:
session 'F' plays the stolen-figurine session, 1995-01-01 .. 1997-12-31 its
window, arrivals after 1996-06-01 are late, and product '1-URGENT' bought
from 1997-01-01 on plays the coffee.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import presence as P
from weir.sources import datasets as D

# Fixed values of the investigation (see module doc).
SESSION = "F"
WINDOW_START = "1995-01-01 00:00:00"
WINDOW_END = "1997-12-31 00:00:00"
LATE_AFTER = "1996-06-01 00:00:00"
PRODUCT = "1-URGENT"
BOUGHT_SINCE = "1997-01-01 00:00:00"
MIN_PURCHASES = 3


def _ntz(v: str):
    return F.lit(v).cast("timestamp_ntz")


def outer_join_range_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspects without an alibi."""
    return P.absent_or_late(
        D.lab_people(spark, sf_dir), D.lab_swipes(spark, sf_dir), SESSION,
        _ntz(WINDOW_START), _ntz(WINDOW_END), _ntz(LATE_AFTER),
    )


def repeat_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeat buyers with count and first time."""
    return P.repeat_buyers(D.lab_purchases(spark, sf_dir), PRODUCT, _ntz(BOUGHT_SINCE), MIN_PURCHASES)


# M1 / M2: the investigation as SQL text with CTEs, over DataFrames bound
# as parameters (no session-wide view names are taken).
ALIBI_SQL = """
WITH late_entries AS (
    SELECT DISTINCT badge_uid, ts AS entered
    FROM {swipes}
    WHERE session_code = :session
      AND ts >= TIMESTAMP_NTZ '%(start)s' AND ts <= TIMESTAMP_NTZ '%(end)s'
      AND ts > TIMESTAMP_NTZ '%(late)s'
),
buyers AS (
    SELECT badge_uid, min(ts) AS earliest, count(*) AS bought
    FROM {purchases}
    WHERE ts >= TIMESTAMP_NTZ '%(since)s' AND product = :product
    GROUP BY badge_uid
)
SELECT DISTINCT
    badge_uid,
    who.full_name AS thief_name,
    md5(lower(trim(who.full_name))) AS verification_hash,
    entered AS late_arrival_to_session,
    earliest AS first_coffee_time,
    bought AS coffees_bought_after_15h
FROM buyers JOIN late_entries USING (badge_uid) JOIN {people} who USING (badge_uid)
WHERE bought >= :min_count
ORDER BY first_coffee_time ASC NULLS LAST
"""


def run_alibi_sql(spark: SparkSession, people: DataFrame, swipes: DataFrame,
                  purchases: DataFrame, session: str = SESSION, start: str = WINDOW_START,
                  end: str = WINDOW_END, late: str = LATE_AFTER, product: str = PRODUCT,
                  since: str = BOUGHT_SINCE, min_count: int = MIN_PURCHASES) -> DataFrame:
    for v in (start, end, late, since):  # become typed literals in the text
        if "'" in v:
            raise ValueError("timestamp literal must not contain quotes")
    text = ALIBI_SQL % {"start": start, "end": end, "late": late, "since": since}
    return spark.sql(
        text,
        args={"session": session, "product": product, "min_count": min_count},
        people=people, swipes=swipes, purchases=purchases,
    )


def alibi_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late arrivals who are repeat buyers, with hash."""
    return run_alibi_sql(
        spark, D.lab_people(spark, sf_dir), D.lab_swipes(spark, sf_dir), D.lab_purchases(spark, sf_dir)
    )


def alibi_intersection_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result from the DataFrame operators (skew-safe joins)."""
    return P.late_and_jittery(outer_join_range_on(spark, sf_dir), repeat_buyers(spark, sf_dir))


def union_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count per loaded table, as one result."""
    parts = [
        ("people", D.lab_people(spark, sf_dir)),
        ("sessions", D.lab_sessions(spark, sf_dir)),
        ("swipes", D.lab_swipes(spark, sf_dir)),
        ("purchases", D.lab_purchases(spark, sf_dir)),
    ]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = c if out is None else out.unionAll(c)
    return out


# ------------------------------------------------------------- CSV demo
SAMPLE_AGE_ABOVE = 30


def filter_greater(spark: SparkSession, sf_dir: str) -> DataFrame:
    """people older than 30."""
    return D.sample_people(spark, sf_dir).filter(F.col("age") > SAMPLE_AGE_ABOVE)


def global_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record count and average age as text with 1 decimal."""
    return D.sample_people(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("records"),
        F.format_number(F.avg("age"), 1).alias("average_age"),
    )


def sql_group_avg_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temp view queried by SQL, grouped, ordered by alias. The
    view has a name of its own, so it replaces none of the caller's."""
    view = f"people_{uuid.uuid4().hex}"
    D.sample_people(spark, sf_dir).createTempView(view)
    return spark.sql(
        f"""
        SELECT city, COUNT(*) AS count, AVG(age) AS avg_age
        FROM {view}
        GROUP BY city
        ORDER BY avg_age DESC
        """
    )


def lab_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 on the lab tables: PRIMARY KEY / UNIQUE, NOT NULL and VARCHAR(n)
    violations per table and column, before loading."""
    from weir.operators.quality import constraint_violations
    from weir.schemas import LAB_RULES

    tables = {
        "sessions": D.lab_sessions(spark, sf_dir), "people": D.lab_people(spark, sf_dir),
        "swipes": D.lab_swipes(spark, sf_dir), "purchases": D.lab_purchases(spark, sf_dir),
    }
    out = None
    for name, (rules, unique) in LAB_RULES.items():
        r = constraint_violations(tables[name], rules, unique=unique).select(
            F.lit(name).alias("table_name"), "rule", "column_name", "violations"
        )
        out = r if out is None else out.unionByName(r)
    return out
