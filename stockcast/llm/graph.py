"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import materialize


def _least(edges: DataFrame) -> DataFrame:
    """Per node of u the smallest node among itself and its neighbours v."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of `edges` (u, v: long): root is the smallest node it is linked with.

    Each round lets all larger neighbours of a node point to its smallest neighbour (large star), then all smaller ones
    (small star). The number of edges never grows and the rounds grow with the logarithm of the longest chain. Sums and
    minima are taken before each shuffle; a hub's edges are only joined with its one minimum, which Spark splits at run time.
    Every round is written to the shared folder.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both).withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        )
        small = (
            large.join(_least(large).withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
                                      F.struct("u", F.col("least").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        after = materialize(small)
        same = after.count() == now.count() and after.join(now, ["u", "v"], "left_anti").isEmpty()
        now = after
        if same:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
