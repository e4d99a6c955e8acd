"""Presence and repeat-buyer investigation.

suspects: people LEFT JOIN swipes ON badge AND session = s AND ts BETWEEN
[start, end] (conditions in ON, so people without a matching swipe stay),
WHERE ts IS NULL OR ts > late; DISTINCT (badge, name, ts).

Built as inner join + anti join instead of one outer join: the swipes side
is the big, possibly skewed one, and in an outer join it would be the side
AQE cannot split. Here swipes stream through an inner join (AQE splits a
hot badge) and the "no swipe" branch is an anti join against the
*distinct* swiping badges (combined map-side). Same rows as the outer join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.columns import name_hash


def absent_or_late(people: DataFrame, swipes: DataFrame, session: str,
                           start, end, late_after) -> DataFrame:
    in_window = swipes.filter(
        (F.col("session_code") == session) & F.col("ts").between(start, end)
    ).select("badge_uid", "ts")
    late = (
        in_window.filter(F.col("ts") > late_after)
        .join(people.select("badge_uid", "full_name"), "badge_uid")
        .select("badge_uid", "full_name", F.col("ts").alias("arrival_time"))
    )
    absent = (
        people.select("badge_uid", "full_name")
        .join(in_window.select("badge_uid").distinct(), "badge_uid", "left_anti")
        .select("badge_uid", "full_name", F.lit(None).cast(swipes.schema["ts"].dataType).alias("arrival_time"))
    )
    return late.unionByName(absent).distinct()


def repeat_buyers(purchases: DataFrame, product: str, since, min_count: int = 3) -> DataFrame:
    """Buyers of `product` from `since` on with at least `min_count`
    purchases: count and first purchase time (grouped, map-side combined)."""
    return (
        purchases.filter((F.col("product") == product) & (F.col("ts") >= since))
        .groupBy("badge_uid")
        .agg(F.count(F.lit(1)).alias("coffee_count"), F.min("ts").alias("first_coffee_time"))
        .filter(F.col("coffee_count") >= min_count)
    )


def late_and_jittery(suspects: DataFrame, buyers: DataFrame) -> DataFrame:
    """Late arrivals (not absentees) who are also repeat buyers."""
    j = suspects.filter(F.col("arrival_time").isNotNull()).join(buyers, "badge_uid")
    return j.select(
        F.col("full_name").alias("thief_name"),
        "badge_uid",
        F.col("arrival_time").alias("late_arrival_to_session"),
        F.col("coffee_count").alias("coffees_bought_after_15h"),
        "first_coffee_time",
        name_hash("full_name").alias("verification_hash"),
    ).orderBy(F.col("first_coffee_time").asc_nulls_last())
