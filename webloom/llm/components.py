"""Connected components by star contraction: narrow joins and aggregates, each round written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.tables import shared_path

MAX_ROUNDS = 60
PARTS = 16


def _minima(edges: DataFrame) -> DataFrame:
    """(u, low): the smallest neighbour of each u, or u itself."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _round(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's minimum, then every node to the minimum of its smaller ones."""
    sym = _both(edges)
    large = (sym.where("v > u").join(_minima(sym), "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
    low = _minima(large)
    return (large.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v")))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node but the smallest of its component, with that smallest node as v.

    ``links`` has columns u, v in any order and with any repeats. A hub's edges are counted by partial aggregation and
    joined, never gathered. Rounds grow with the logarithm of a component's diameter; the loop ends when a round
    changes nothing, which is when every component is a star around its minimum.
    """
    spark = links.sparkSession
    base = shared_path(spark, "components")

    def kept(edges: DataFrame, k: int) -> tuple[DataFrame, tuple]:
        edges.write.parquet(f"{base}/{k}")
        stored = spark.read.parquet(f"{base}/{k}")
        seen = stored.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return stored, tuple(seen)

    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges, state = kept(edges, 0)
    for k in range(1, MAX_ROUNDS):
        after, new = kept(_round(edges), k)
        if new == state:
            return after
        edges, state = after, new
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
