"""Profiles that add up: counts, moments, ranges and distinct sketches per period.

A state has one row per (period, column). Rows of different periods are merged
into the profile of any set of periods, so a new month costs one scan of that
month and no second look at the old ones. Sketches have the error that ``rsd``
asks for; all else is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.profile import batches, sketch_size
from tidemark.sources.lake import append_or_create

_STATE = ("n", "n_null", "n_number", "mean", "m2", "low_number", "high_number", "low_text", "high_text", "distinct")


def profile_state(df: DataFrame, period: str, columns: list[str], rsd: float = 0.015, step: int = 50) -> DataFrame:
    """(period, column, ...): what adds up over periods, in one scan per batch of columns.

    Numbers have moments and a range of numbers, all columns a range as text. A
    period without rows has no state; a null period is a period.
    """
    size, kinds = sketch_size(rsd), {f.name: f.dataType for f in df.schema}
    parts = []
    for batch in batches(columns, step):
        measured = [_measures(c, isinstance(kinds[c], T.NumericType), size).alias(c) for c in batch]
        wide = df.groupBy(F.col(period).alias("period")).agg(*measured)
        parts.append(wide.unpivot("period", batch, "column", "_found").select("period", "column", "_found.*"))
    return reduce(DataFrame.unionByName, parts)


def _measures(c: str, numeric: bool, size: int) -> Column:
    column, text = F.col(f"`{c}`"), F.col(f"`{c}`").cast("string")
    number = column.cast("double") if numeric else F.lit(None).cast("double")
    found = (
        F.count(F.lit(1)),
        F.count_if(column.isNull()),
        F.count(number),
        F.avg(number),
        F.var_pop(number) * F.count(number),
        F.min(number),
        F.max(number),
        F.min(text),
        F.max(text),
        F.hll_sketch_agg(F.when(text.isNotNull(), F.xxhash64(text)), size),
    )
    return F.struct(*[x.alias(n) for n, x in zip(_STATE, found)])


def merge_state(state: DataFrame) -> DataFrame:
    """(column, n, null_share, n_distinct, mean, var_samp, var_pop, low_number,
    high_number, low_text, high_text) over the periods in ``state``."""
    n, m2 = F.sum("n_number"), F.sum("m2")
    mean = F.try_divide(F.sum(F.col("mean") * F.col("n_number")), n)
    merged = state.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum("n_null"), F.sum("n")).alias("null_share"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("distinct")), F.lit(0)).alias("n_distinct"),
        n.alias("_numbers"),
        mean.alias("mean"),
        m2.alias("_within"),
        # One small pair per period; a sum of squares of raw means would cancel.
        F.collect_list(F.when(F.col("n_number") > 0, F.struct("n_number", "mean"))).alias("_means"),
        *[F.min(c).alias(c) for c in ("low_number", "low_text")],
        *[F.max(c).alias(c) for c in ("high_number", "high_text")],
    )
    apart = F.aggregate(
        "_means", F.lit(0.0), lambda sum_, x: sum_ + x["n_number"] * (x["mean"] - F.col("mean")) * (x["mean"] - F.col("mean"))
    )
    merged = merged.withColumn("_m2", F.col("_within") + apart)
    return merged.select(
        "column", "n", "null_share", "n_distinct", "mean",
        F.when(F.col("_numbers") > 1, F.col("_m2") / (F.col("_numbers") - 1)).alias("var_samp"),
        F.when(F.col("_numbers") > 0, F.col("_m2") / F.col("_numbers")).alias("var_pop"),
        "low_number", "high_number", "low_text", "high_text",
    )


def keep_state(
    spark: SparkSession, name: str, df: DataFrame, period: str, columns: list[str], rsd: float = 0.015
) -> DataFrame:
    """Adds the periods that table ``name`` lacks and returns the whole state. Only
    rows of new periods are profiled, an old one stays as it was found first; a period
    is written as a whole, so a job that is run again adds nothing twice."""
    if spark.catalog.tableExists(name):
        known = spark.table(name).select(F.col("period").alias("_known")).distinct()
        df = df.join(F.broadcast(known), F.col(period).eqNullSafe(F.col("_known")), "left_anti")
    append_or_create(profile_state(df, period, columns, rsd), name, ["period"], replace=True)
    return spark.table(name)


def of_periods(state: DataFrame, periods: Sequence) -> DataFrame:
    return state.where(F.col("period").isin(list(periods)))
