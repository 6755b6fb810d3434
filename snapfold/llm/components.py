"""Connected components of a distributed edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    to_least = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(a, b) long pairs to (node, component), component the smallest node reachable; nodes without an edge don't appear.

    A node's neighbours are only ever joined and reduced to their minimum, never collected. Each round is written to the
    shared folder. The rounds end when nothing changes, as logarithmically many do.
    """
    turned = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, state = written(turned, "edges"), None
    for _ in range(rounds):
        now = written(_small_star(_large_star(now)), "edges")
        new = now.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    else:
        raise RuntimeError("the components did not settle")
    roots = now.groupBy("b").agg(F.max("b").alias("component")).select(F.col("b").alias("node"), "component")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
