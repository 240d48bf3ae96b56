"""Merged reports as long frames: one table instead of one sheet per part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_label


def feature_selection_report(
    importance: DataFrame | None = None,
    chi_square: DataFrame | None = None,
    cramer: DataFrame | None = None,
    mutual: DataFrame | None = None,
) -> DataFrame:
    """(method, feature, statistic, strength) of every report that exists."""
    given = (
        ("infogain", importance, "importance"),
        ("chisqrd", chi_square, "chi2"),
        ("cramer", cramer, "cramer_v"),
        ("mtinfo", mutual, "mutual_information"),
    )
    parts = [
        df.select(
            F.lit(method).alias("method"),
            "feature",
            F.col(stat).cast("double").alias("statistic"),
            (F.col("strength") if "strength" in df.columns else F.lit(None).cast("string")).alias("strength"),
        )
        for method, df, stat in given
        if df is not None
    ]
    if not parts:
        raise ValueError("no feature report given")
    return reduce(DataFrame.unionByName, parts)


def performance_report(
    metrics: DataFrame,
    importance: DataFrame | None,
    ks_by_split: DataFrame,
    ks_by_month: DataFrame,
    split: str,
    period: str,
) -> DataFrame:
    """(section, row, column, value): metrics, importances, KS of train and
    test, and KS of each validation month. The section names are fixed values."""
    parts = [_long(metrics, F.lit("METRICS"), "metric_name")]
    if importance is not None:
        parts.append(_long(importance, F.lit("FEAT_IMPORT_MODEL"), "feature"))
    fitted = ks_by_split.where(F.col(split).isin("train", "test"))
    parts.append(_long(fitted, F.concat(F.lit("KS_"), F.upper(split)), "decile", split))
    parts.append(_long(ks_by_month, F.concat(F.lit("KS_VAL"), month_label(period)), "decile", period))
    return reduce(DataFrame.unionByName, parts)


def _long(df: DataFrame, section, row: str, *keys: str) -> DataFrame:
    values = [c for c in df.columns if c not in (row, *keys)]
    return df.select(
        section.alias("section"), F.col(row).cast("string").alias("row"), *[F.col(c).cast("double").alias(c) for c in values]
    ).unpivot(["section", "row"], values, "column", "value")
