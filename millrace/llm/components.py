"""Connected components by alternating large and small stars, each round a pair of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(a, root)`` for every node of ``edges(a, b)`` but the roots; a root is the smallest
    node of its component.

    Rounds are stored in the shared folder; only a count and a checksum reach the driver. A
    node with very many links is aggregated map-side and then joined to a single row.
    """
    edges = stored(
        edges.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "edges",
    )
    state = _signature(edges)
    while state[0]:
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m")
        )
        large = (
            both.join(least, both.a == least.u)
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = (
            large.join(least, large.a == least.u)
            .select(F.explode(F.array("b", "a")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "small-star")
        before, state = state, _signature(edges)
        if state == before:
            break
    return edges.select("a", F.col("b").alias("root"))
