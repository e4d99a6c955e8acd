"""Column expressions shared by the plans (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 / C1 / C2 --------------------------------------------------------------
def parse_timestamp(ts, strict: bool = True) -> Column:
    """ISO-8601 text (with offset) -> TIMESTAMP. Strict mode fails on bad
    text (ANSI); lenient mode yields null instead."""
    c = col_of(ts)
    return F.to_timestamp(c) if strict else F.try_to_timestamp(c)


def parse_date(ts, strict: bool = True) -> Column:
    """The calendar date written in the text (its own offset, not UTC)."""
    c = col_of(ts)
    return F.to_date(c) if strict else F.try_to_date(c)


# P2 / C3 / C4 --------------------------------------------------------------
MONEY = "decimal(12,2)"


def purchase_revenue(event="event", price="props.price", money_type: str = MONEY) -> Column:
    """Price for a purchase, 0 otherwise; a purchase without price stays
    null (and is dropped by the non-negative filter)."""
    return (
        F.when(col_of(event) == "purchase", col_of(price))
        .otherwise(F.lit(0.0))
        .cast(money_type)
    )


# P11 / P12 / P14 -----------------------------------------------------------
def empty_if_null(arr, element_type: str = "string") -> Column:
    return F.coalesce(col_of(arr), F.array().cast(f"array<{element_type}>"))


def false_if_null(b) -> Column:
    return F.coalesce(col_of(b), F.lit(False))


# C5 -----------------------------------------------------------------------
def name_hash(name) -> Column:
    return F.md5(F.lower(F.trim(col_of(name))))


# C9 -----------------------------------------------------------------------
def ntz_to_epoch_millis(ts) -> Column:
    """TIMESTAMP_NTZ (UTC wall time; the session zone is pinned to UTC by
    `apply_result_conf`) -> epoch millis."""
    return F.unix_millis(col_of(ts).cast("timestamp"))
