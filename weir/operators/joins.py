"""Joins whose strategy follows a *measured* size, never a guess.

`broadcast()` ships a whole table to every executor, so it is only safe for
a side whose size is bounded. `measure_bounded` counts the rows and real byte
width of the (already filtered and projected) side by one plain aggregate. If the
side fits, it is broadcast; otherwise the join stays a shuffle join, where AQE
may still switch to a broadcast at run time and splits skewed (hot-key)
partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
HOPELESS_BYTES = 64 * DEFAULT_MAX_BYTES  # a side this large by its files is not worth a scan to measure it


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int


def _width(c: Column, dt: T.DataType) -> Column:
    """In-memory byte width of one value (strings and arrays by content)."""
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(dt, T.ArrayType):
        inner = F.aggregate(c, F.lit(0).cast("long"), lambda acc, x: acc + _width(x, dt.elementType))
        return F.coalesce(inner, F.lit(0).cast("long")) + F.lit(16)
    if isinstance(dt, T.StructType):
        total = F.lit(8).cast("long")
        for f in dt.fields:
            total = total + _width(c.getField(f.name), f.dataType)
        return total
    if isinstance(dt, T.MapType):
        return F.coalesce(F.size(c).cast("long"), F.lit(0)) * F.lit(64) + F.lit(16)
    return F.lit(_fixed_width(dt)).cast("long")


def _fixed_width(dt: T.DataType) -> int:
    if isinstance(dt, (T.BooleanType, T.ByteType, T.NullType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    return 8


def _planned_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the side's size (of a scan: its files' bytes)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def measure_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                    hopeless_bytes: int = HOPELESS_BYTES) -> SideSize | None:
    """Exact rows and bytes of `df` if it has at most `max_rows` rows, else
    None (no bound proven). One aggregate whose tasks each return one row;
    it is run anew every time, so a rewritten file is measured as it is now.
    A side planned at more than `hopeless_bytes` is not measured."""
    try:
        if _planned_bytes(df) > hopeless_bytes:
            return None
    except (AttributeError, TypeError):  # Spark Connect: no plan statistics
        pass
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = width + _width(F.col(f"`{f.name}`"), f.dataType)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    n, b = int(row["n"]), int(row["b"] or 0)
    return SideSize(n, b) if n <= max_rows else None


def broadcast_if_bounded(
    df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES
) -> tuple[DataFrame, bool]:
    """Return (df with a broadcast hint, True) when its measured size fits,
    else (df unchanged, False)."""
    size = measure_bounded(df, max_rows)
    if size is not None and size.bytes <= max_bytes:
        return F.broadcast(df), True
    return df, False
