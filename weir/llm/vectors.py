"""Vector tables as both vector searches take them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(df: DataFrame, id_col: str, vector_col: str, *kept: str) -> DataFrame:
    """`vec_id`, `v` (array of double) and `kept` columns of the rows whose id and
    vector are known and whose components are all known and finite."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), *kept)
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good)


def matrix(column, kind) -> np.ndarray:
    """A list column of one Arrow table, all lists of one length, as a matrix."""
    chunk = column.combine_chunks()
    flat = np.asarray(chunk.flatten()).astype(kind, copy=False)
    return flat.reshape(len(chunk), -1 if len(flat) else 0)
