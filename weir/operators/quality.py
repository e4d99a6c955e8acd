"""Data-quality checks: declared constraints (V1), domain rules (V2) and
the counting checks (A10, A12, A14). Each returns a small DataFrame of
per-rule counts or a valid/rejected split - never a driver-side loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constraint_violations(df: DataFrame, rules: Sequence[tuple[str, int | None, bool]],
                          unique: Sequence[str] = ()) -> DataFrame:
    """V1: one row per (rule, column_name) with the number of violating rows.

    One scan: NOT NULL and VARCHAR(n) are conditional counts; UNIQUE counts
    the rows beyond the first per key, count(key) - count(DISTINCT key),
    whose distinct part Spark combines map-side before its exchange.
    """
    aggs, names = [], []
    for col, max_len, not_null in rules:
        if not_null:
            aggs.append(F.count_if(F.col(col).isNull()).alias(f"nn_{col}"))
            names.append(("not_null", col, f"nn_{col}"))
        if max_len is not None:
            aggs.append(F.count_if(F.char_length(col) > max_len).alias(f"len_{col}"))
            names.append((f"max_length_{max_len}", col, f"len_{col}"))
    for key in unique:
        aggs.append((F.count(key) - F.countDistinct(key)).cast("long").alias(f"uq_{key}"))
        names.append(("unique", key, f"uq_{key}"))
    stack = ", ".join(f"'{r}', '{c}', {a}" for r, c, a in names)
    return df.agg(*aggs).selectExpr(f"stack({len(names)}, {stack}) AS (rule, column_name, violations)")


def valid_rejected(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """V2: each rule is a boolean 'ok' column; adds `failed_rules` (array of
    rule names whose check is false or null) and `valid`."""
    failed = F.array_compact(F.array(*[
        F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()
    ]))
    return df.withColumn("failed_rules", failed).withColumn("valid", F.size("failed_rules") == 0)


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows vs distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("unique_ids"))


def dataset_counts(named: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Record count per dataset as one result (UNION ALL)."""
    out = None
    for name, df in named:
        c = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("dataset"), "records")
        out = c if out is None else out.unionAll(c)
    return out
