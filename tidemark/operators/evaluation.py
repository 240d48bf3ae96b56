"""Classification metrics, areas under curves and KS tables, per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_totals
from tidemark.operators.scoring import score_buckets

CLASS_METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")
AREA_METRICS = ("areaUnderROC", "areaUnderPR")

# The columns of a KS table, in order.
KS_COLUMNS = (
    "decile", "n", "min_score", "max_score", "avg_score", "positives", "negatives", "event_rate",
    "cum_event_rate", "pct_pos", "pct_neg", "cum_pct_pos", "cum_pct_neg", "lift", "ks",
)


def class_metrics(df: DataFrame, target: str, prediction: str = "prediction", groups: list[str] | None = None) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1, from one count of
    the confusion matrix per group."""
    known = df.where(F.col(target).isNotNull())
    cells = known.groupBy(*(groups or [])).agg(*_confusion(target, prediction))
    return cells.select(*(groups or []), *_class_columns())


def _confusion(target: str, prediction: str) -> list[Column]:
    hit, said = F.col(target) == 1, F.col(prediction) == 1
    return [
        F.count_if(hit & said).alias("tp"),
        F.count_if(~hit & said).alias("fp"),
        F.count_if(~hit & ~said).alias("tn"),
        F.count_if(hit & ~said).alias("fn"),
    ]


def _class_columns() -> list[Column]:
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def weighted(positive: Column, negative: Column) -> Column:
        return F.try_divide((tp + fn) * positive + (tn + fp) * negative, n)

    precision = ratio(tp, tp + fp), ratio(tn, tn + fn)
    recall = ratio(tp, tp + fn), ratio(tn, tn + fp)
    f1 = [ratio(2 * p * r, p + r) for p, r in zip(precision, recall)]
    return [
        F.try_divide(tp + tn, n).alias("accuracy"),
        weighted(*precision).alias("weightedPrecision"),
        weighted(*recall).alias("weightedRecall"),
        weighted(*f1).alias("f1"),
    ]


def area_metrics(df: DataFrame, target: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """Exact areas under the ROC and precision-recall curves. Rows are first
    counted per distinct score, so ties cost nothing; a group with one class
    has null areas."""
    groups = groups or []
    return _areas(df, target, score, groups, [], []).select(*groups, *AREA_METRICS)


def _areas(df: DataFrame, target: str, score: str, groups: list[str], counts: list[Column], sums: list[str]) -> DataFrame:
    """Areas per group, with further ``counts`` carried along and summed."""
    per_score = (
        df.where(F.col(target).isNotNull())
        .groupBy(*groups, F.col(score).alias("_score"))
        .agg(F.count_if(F.col(target) == 1).alias("_p"), F.count_if(F.col(target) != 1).alias("_n"), *counts)
    )
    curve = running_totals(
        per_score, [F.desc("_score")], {"_tp": "_p", "_fp": "_n"}, groups, {"_pos": "_p", "_neg": "_n"}
    )
    p, n, tp, fp = (F.col(c).cast("double") for c in ("_p", "_n", "_tp", "_fp"))
    precision = tp / (tp + fp)
    # The curve starts at recall 0 with the precision of its first point.
    earlier = F.coalesce(F.try_divide(tp - p, tp - p + fp - n), precision)
    both = (F.max("_pos") > 0) & (F.max("_neg") > 0)
    scale = F.max("_pos").cast("double")
    return curve.groupBy(*groups).agg(
        F.when(both, F.try_divide(F.sum(n * (2 * tp - p) / 2), scale * F.max("_neg"))).alias("areaUnderROC"),
        F.when(both, F.try_divide(F.sum(p * (precision + earlier) / 2), scale)).alias("areaUnderPR"),
        *[F.sum(c).alias(c) for c in sums],
    )


def metrics_report(
    df: DataFrame,
    target: str,
    score: str,
    prediction: str = "prediction",
    split: str | None = None,
    splits: tuple[str, ...] = ("train", "test", "val"),
) -> DataFrame:
    """``metric_name`` and one value column per split, or one column ``value``.
    One pass over the rows: the confusion counts ride along per score."""
    groups = [split] if split else []
    cells = ["tp", "fp", "tn", "fn"]
    both = _areas(df, target, score, groups, _confusion(target, prediction), cells)
    wide = both.select(*groups, *_class_columns(), *AREA_METRICS)
    long = wide.unpivot(groups, [*CLASS_METRICS, *AREA_METRICS], "metric_name", "value")
    if not split:
        return long
    return long.groupBy("metric_name").pivot(split, list(splits)).agg(F.first("value"))


def ks_table(df: DataFrame, target: str, score: str, bucket: str = "deciles", groups: list[str] | None = None) -> DataFrame:
    """Event rates, cumulative shares, lift and KS per score bucket. After the
    one grouped count a group has as many rows as buckets."""
    groups = groups or []
    hit = F.count_if(F.col(target) == 1)
    counted = (
        df.where(F.col(target).isNotNull())
        .groupBy(*groups, F.col(bucket).alias("decile"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(score).alias("min_score"),
            F.max(score).alias("max_score"),
            F.avg(score).alias("avg_score"),
            hit.alias("positives"),
            F.count_if(F.col(target) != 1).alias("negatives"),
        )
    )
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    upto = whole.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)

    def total(c: str) -> Column:
        return F.sum(c).over(whole)

    def running(c: str) -> Column:
        return F.sum(c).over(upto)

    table = counted.withColumns(
        {
            "event_rate": F.col("positives") / F.col("n"),
            "cum_event_rate": running("positives") / running("n"),
            "pct_pos": F.try_divide(F.col("positives"), total("positives")),
            "pct_neg": F.try_divide(F.col("negatives"), total("negatives")),
            "cum_pct_pos": F.try_divide(running("positives"), total("positives")),
            "cum_pct_neg": F.try_divide(running("negatives"), total("negatives")),
            "_base": total("positives") / total("n"),
        }
    )
    return table.withColumns(
        {
            "lift": F.try_divide("event_rate", "_base"),
            "ks": F.abs(F.col("cum_pct_pos") - F.col("cum_pct_neg")),
        }
    ).select(*groups, *KS_COLUMNS)


def ks_by_period(
    df: DataFrame, target: str, score: str, ties: list[str], period: str, buckets: int = 10, error: float = 0.0
) -> DataFrame:
    """KS tables of all periods in one job, buckets recomputed within each."""
    again = score_buckets(df, score, ties, [period], buckets, error, "_bucket")
    return ks_table(again, target, score, "_bucket", [period])
