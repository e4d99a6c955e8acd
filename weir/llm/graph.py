"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from weir.session import scratch_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node ties its larger (large star) or its smaller neighbours (small
    star) to the smallest of its neighbourhood. The smallest is a combined
    aggregate and the tie a join whose hot keys AQE splits: no neighbour list is
    ever held by one task."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = both if large else both.where("b < a")
    low = pairs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("k"), F.least("m", "k").alias("m"))
    tied = pairs.join(low, pairs.a == low.k)
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the smallest node
    of the component. Each round is written to the shared folder, which cuts
    the lineage and survives lost executors."""
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def state(df: DataFrame):
        return tuple(df.agg(F.count("a"), F.sum(F.hash("a", "b").cast("long"))).first())

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = written(_star(_star(now, True), False))
        new = state(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
