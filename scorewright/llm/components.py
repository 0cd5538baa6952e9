"""Connected components of a graph given as edges: alternating large-star and small-star steps.

Works on edge rows only; every step is a grouped aggregation, its result is stored in the shared folder, and a star's
centre needs no list of its neighbours in one place (the least neighbour is a partial minimum, joined back).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import store


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``id, component`` (least id) for every vertex of ``edges`` (``a, b`` longs); vertices without edges are absent."""
    pairs = store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        # large star: every neighbour larger than u is tied to the least vertex around u
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: every vertex and its smaller neighbours are tied to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        pairs = store(small, "stars")
        now = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("decimal(38,0)").alias("s"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    done = pairs.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    return done.unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
