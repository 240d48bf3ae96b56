"""Spine columns, period lists and prior reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sampling import RESAMPLE_SEED, kept
from tidemark.operators.ordering import ranked
from tidemark.options import SpineColumns


def cast_target(df: DataFrame, target: str = "target") -> DataFrame:
    """Target as an integer; text that is no number becomes null."""
    return df.withColumn(target, F.col(target).try_cast("int"))


def with_id(df: DataFrame, spine: SpineColumns) -> DataFrame:
    """Artificial id 1..N in order of (date, ident)."""
    return ranked(df, [F.col(spine.date).asc(), F.col(spine.ident).asc()], rank=spine.id)


def distinct_periods(df: DataFrame, date: str) -> DataFrame:
    return df.select(date).distinct().orderBy(date)


def resample(df: DataFrame, perc: float, spine: SpineColumns, seed: int = RESAMPLE_SEED) -> DataFrame:
    """About ``perc`` of the rows, chosen by key."""
    return df.where(kept(perc, seed, spine.ident, spine.date))


def prior_report(original: DataFrame, sampled: DataFrame, spine: SpineColumns) -> DataFrame:
    """Event rate per period before and after sampling; both frames are train rows."""
    sides = []
    for df, suffix in ((original, "orig"), (sampled, "sampled")):
        sides.append(
            df.groupBy(F.col(spine.date).alias("month")).agg(
                F.count(spine.target).alias(f"n_{suffix}"),
                F.coalesce(F.sum(F.col(spine.target).cast("bigint")), F.lit(0)).alias(f"pos_{suffix}"),
                F.avg(F.col(spine.target).cast("double")).alias(f"prior_{suffix}"),
            )
        )
    return sides[0].join(sides[1], "month", "left").select(
        "month",
        "n_orig",
        "pos_orig",
        "prior_orig",
        F.coalesce("n_sampled", F.lit(0)).alias("n_sampled"),
        F.coalesce("pos_sampled", F.lit(0)).alias("pos_sampled"),
        "prior_sampled",
    )


def split_rows(df: DataFrame, spine: SpineColumns, split: str) -> DataFrame:
    return df.where(F.col(spine.ind_split) == split)


def union_splits(*frames: DataFrame) -> DataFrame:
    """Stacks splits by column name."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def redistribute(df: DataFrame, n_part: int | None, *keys: str) -> DataFrame:
    """Even partitions before a wide write: ``n_part`` hash partitions on
    ``keys``, or with None a rebalance that lets adaptive execution size and
    split them."""
    if n_part is None:
        return df.hint("rebalance", *keys)
    return df.repartition(n_part, *keys)
