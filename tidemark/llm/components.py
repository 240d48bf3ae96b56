"""Connected components of a graph given as edges.

Alternates two contractions until nothing changes: every node points its larger
neighbours at the smallest node around it, then itself and its smaller
neighbours at the smallest of those. Both are an aggregate with map-side
minimum and a join, so a node with very many neighbours is neither collected
nor kept in one task (adaptive execution splits its side of the join). Each
round is staged in the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import stage


def components(edges: DataFrame, one: str, other: str) -> DataFrame:
    """(``node``, ``component``): the smallest node reachable, for all nodes with an edge to another.

    Edges with a null end are ignored.
    """
    a, b = F.col(one), F.col(other)
    links = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    links = stage(links.distinct(), "links")
    mark = None
    while True:
        links = stage(_small(_large(links)), "links")
        sums = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == mark:
            break
        mark = tuple(sums)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
    m = F.least("m", "u")
    joined = both.join(least, F.col("u") == F.col("at"))
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), m.alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
    joined = links.join(least, F.col("u") == F.col("at"))
    pointed = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pointed.union(least.select("at", "m")).distinct()
