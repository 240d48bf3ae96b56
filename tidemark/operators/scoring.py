"""Scores and score buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import run_stamp
from tidemark.functions.scores import bucket_of_rank, logit, positive_probability
from tidemark.operators.ordering import quantiles, ranked
from tidemark.sources.staging import pinned


def score_proba(df: DataFrame, name: str = "score", probability: str = "probability", is_vector: bool = True) -> DataFrame:
    return df.withColumn(name, positive_probability(probability, is_vector))


def score_logit(df: DataFrame, name: str = "score_alt", probability: str = "probability", is_vector: bool = True) -> DataFrame:
    return df.withColumn(name, logit(positive_probability(probability, is_vector)))


def score_buckets(
    df: DataFrame,
    score: str,
    ties: list[str],
    groups: list[str] | None = None,
    buckets: int = 10,
    error: float = 0.0,
    name: str = "deciles",
) -> DataFrame:
    """Buckets of equal size within each group, 1 for the highest scores.

    ``error`` = 0 ranks exactly (ties by ``ties``); otherwise buckets follow
    approximate score quantiles and equal scores share a bucket. Rows without a
    score have no bucket and do not count for the others.
    """
    known = F.col(score).isNotNull()
    if error == 0:
        order = [F.desc(score), *[F.asc(c) for c in ties]]
        placed = ranked(df.withColumn("_known", known), order, [*(groups or []), "_known"], rank="_rank", total="_total")
        bucket = F.when(known, bucket_of_rank("_rank", "_total", buckets))
        return placed.withColumn(name, bucket).drop("_rank", "_total", "_known")
    cut = {f"_cut{i}": i / buckets for i in range(1, buckets)}
    if not groups:
        return score_buckets(df.withColumn("_all", F.lit(0)), score, ties, ["_all"], buckets, error, name).drop("_all")
    keys = [F.col(g).alias(f"_key_{g}") for g in groups]
    limits = pinned(quantiles(df, groups, score, cut, error=error).select(*keys, F.array(*cut).alias("_cuts")))
    match: Column = F.lit(True)
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_key_{g}"))
    above = F.size(F.filter("_cuts", lambda c: c >= F.col(score)))
    return df.join(limits, match).withColumn(name, F.when(known, above + 1)).drop("_cuts", *[f"_key_{g}" for g in groups])


def with_run_stamp(df: DataFrame, name: str = "exec_time", stamp: str | None = None) -> DataFrame:
    return df.withColumn(name, F.lit(stamp) if stamp else run_stamp())
