"""Connected components by alternating large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantagrid.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(r)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, work: Scratch) -> DataFrame:
    """(id, component) of every node of ``edges`` (u, v): the least id that is reachable.

    Each step groups neighbours with a pre-aggregated minimum and joins it back, so a
    node with very many neighbours is never gathered.
    """
    edges = work.keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while True:
        # large star: neighbours above a node move to the least of its neighbourhood
        near = _both_ways(edges)
        least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its lower neighbours move to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        low = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = low.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = work.keep(small)
        work.drop(edges)
        edges, before, state = after, state, _state(after)
        if state == before:
            break
    roots = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return work.keep(edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(roots))
