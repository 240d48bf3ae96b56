"""Joins of many rows to facts about their keys, where few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most so many keys can hold one part in so many of the rows: the bound of the broadcast.
MOST_HOT = 4096


def split_join(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, most: int = MOST_HOT) -> DataFrame:
    """Inner join of ``rows`` to ``facts`` (unique by ``keys``), without ``weight``.

    ``weight`` counts the rows that a fact matches. The facts that match one part
    in ``most`` of the rows or more, ``most`` of them at the utmost, are broadcast
    and meet their rows where those lie; only rows of rarer keys are shuffled. So
    no task gets the rows of a hot key. Both inputs are read more than once: stage
    them if they are costly. Null keys match nothing; a weight that is too low
    costs balance, never rows.
    """
    total = facts.select(F.sum(weight)).scalar()
    marked = facts.withColumn("_hot", F.col(weight) * most >= total).drop(weight)
    hot = F.broadcast(marked.where("_hot").drop("_hot"))
    common = rows.join(hot, keys)
    rare = rows.join(F.broadcast(marked.where("_hot").select(*keys)), keys, "left_anti")
    return common.unionByName(rare.join(marked.where(~F.col("_hot")).drop("_hot"), keys))
