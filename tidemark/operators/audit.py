"""Drift audits: every variable of every period in one grouped job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import column_quantiles
from tidemark.operators.profile import long_form
from tidemark.sources.staging import stage


def audit_numeric(df: DataFrame, period: str, columns: list[str], error: float = 0.0) -> DataFrame:
    """Counts, moments and quartiles per (month, variable)."""
    found = column_quantiles(
        df.select(F.col(period).alias("month"), *columns),
        ["month"],
        columns,
        "variable",
        {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        interpolate=True,
        error=error,
        extra=lambda value: [
            F.count(F.lit(1)).alias("n"),
            F.count_if(value.isNull()).alias("n_null"),
            F.avg(value.isNull().cast("double")).alias("pct_null"),
            F.count_if(value == 0).alias("n_zero"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        ],
    )
    return found.select(
        "month", "variable", "n", "n_null", "pct_null", "n_zero", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def audit_categorical(df: DataFrame, period: str, columns: list[str], top: int | None = None) -> DataFrame:
    """Counts and shares of every value per (month, variable).

    With ``top``, values beyond the ``top`` most frequent of a (month, variable)
    become one row without value, told by the flag ``rest``; all rows stay counted.
    """
    texts = df.select(F.col(period).alias("month"), *columns)
    counts = stage(
        long_form(texts, ["month"], columns, "variable", "value")
        .groupBy("month", "variable", "value")
        .agg(F.count(F.lit(1)).alias("n")),
        "value-counts",
    )
    groups = ["month", "variable"]
    totals = counts.groupBy(*groups).agg(F.sum("n").alias("_total"))
    share = (F.col("n") / F.col("_total")).alias("pct")
    if top is None:
        return counts.join(totals, groups).select(*groups, "value", "n", share)
    # The limit on the rank also prunes before the shuffle by group.
    order = Window.partitionBy(*groups).orderBy(F.desc("n"), F.asc_nulls_first("value"))
    kept = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top)
    kept = kept.select(*groups, "value", "n", F.lit(False).alias("rest"))
    left = (
        kept.groupBy(*groups)
        .agg(F.sum("n").alias("_kept"))
        .join(totals, groups)
        .where(F.col("_total") > F.col("_kept"))
        .select(*groups, F.lit(None).cast("string").alias("value"), (F.col("_total") - F.col("_kept")).alias("n"), F.lit(True).alias("rest"))
    )
    return kept.unionByName(left).join(totals, groups).select(*groups, "value", "n", "rest", share)
