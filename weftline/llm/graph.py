"""Connected components of an edge list by alternating stars, which takes about log(longest path) rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import cut_lineage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """u, v, m: m the least of u and its neighbours. A join and not a window, so that a hub's rows can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``edges`` (u, v: of one type that has an order, u != v) to (v, root): each node that is not least in its component, with the least one.

    Repeated and mirrored edges do no harm; no edges give no rows. Each round is cut off by a checkpoint.
    """
    current = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(most_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _least_neighbour(large)
        ends = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        current = cut_lineage(ends.select("e.u", "e.v").where("u <> v").distinct())
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return current.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
