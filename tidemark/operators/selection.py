"""Feature ranking against a 0/1 target, and the criteria that keep features."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scores import CRAMER_BANDS, MUTUAL_BANDS, band
from tidemark.operators.ordering import column_quantiles
from tidemark.operators.profile import batches, long_form, numeric_columns
from tidemark.options import Options
from tidemark.plans.labels import LabelTable

# Fixed values.
SEED = 2012
KEPT_BY_CHI_SQUARE = 100


def quantile_cuts(df: DataFrame, columns: list[str], buckets: int = 5, error: float = 0.0) -> DataFrame:
    """(feature, cuts): the distinct discrete quantiles at i/buckets, ascending.

    Nothing lies above a cut at the maximum, so the greatest smaller value takes
    its place: a value that most rows share still gets a bucket of its own.
    """
    probabilities = {f"_c{i}": i / buckets for i in range(1, buckets)}
    found = column_quantiles(
        df, [], columns, "feature", probabilities, error=error, extra=lambda value: [F.max(value).alias("_max")]
    )
    cuts = F.sort_array(F.array_distinct(F.array_compact(F.array(*probabilities))))
    # One row per feature.
    known = {r["feature"]: (r["cuts"], r["_max"]) for r in found.select("feature", "_max", cuts.alias("cuts")).collect()}
    topped = [c for c, (own, most) in known.items() if own and own[-1] == most]
    below: dict[str, float | None] = {}
    for batch in batches(topped, 200):
        number = {c: F.col(c).cast("double") for c in batch}
        row = df.agg(*[F.max(F.when(number[c] < F.lit(known[c][1]), number[c])).alias(c) for c in batch]).first()
        below |= row.asDict()
    rows = []
    for feature, (own, _) in known.items():
        if feature in below:
            own = sorted({*own[:-1], *([] if below[feature] is None else [below[feature]])})
        rows.append((feature, own))
    return df.sparkSession.createDataFrame(rows, "feature string, cuts array<double>")


def bucketed(column: str, cuts: list[float]) -> Column:
    """Number of cuts below the value; null stays null."""
    value = F.col(column).cast("double")
    steps = sum(((value > F.lit(cut)).cast("int") for cut in cuts), F.lit(0))
    return F.when(value.isNotNull(), steps)


def quantile_buckets(df: DataFrame, columns: list[str], buckets: int = 5, error: float = 0.0) -> DataFrame:
    """Numeric columns replaced by their bucket number."""
    cuts = {row["feature"]: row["cuts"] for row in quantile_cuts(df, columns, buckets, error).collect()}
    return df.withColumns({c: bucketed(c, cuts.get(c, [])) for c in columns})


def association(
    train: DataFrame,
    features: list[str],
    target: str,
    buckets: int = 5,
    error: float = 0.0,
) -> DataFrame:
    """(feature, n, bins, chi2, cramer_v, mutual_information) of every feature.

    One unpivot and one count per (feature, bin) serve all three statistics.
    They are written as sums over bins, so no bin needs the totals of its
    feature and an empty cell adds nothing. Rows without target are left out.
    """
    known = train.where(F.col(target).isNotNull())
    numbers = [c for c in numeric_columns(known) if c in features]
    binned = quantile_buckets(known, numbers, buckets, error) if numbers else known
    texts = binned.select(F.col(target).alias("_target"), *[F.col(c).cast("string").alias(c) for c in features])
    long = long_form(texts, ["_target"], features, "feature", "bin")
    bins = long.groupBy("feature", "bin").agg(
        F.count_if(F.col("_target") == 1).alias("_n1"), F.count_if(F.col("_target") != 1).alias("_n0")
    )
    n1, n0 = F.col("_n1").cast("double"), F.col("_n0").cast("double")
    row = n1 + n0
    sums = bins.groupBy("feature").agg(
        F.sum(n1).alias("_c1"),
        F.sum(n0).alias("_c0"),
        F.count(F.lit(1)).alias("bins"),
        F.sum(n1 * n1 / row).alias("_s1"),
        F.sum(n0 * n0 / row).alias("_s0"),
        F.sum(_xlog(n1, n1 / row) + _xlog(n0, n0 / row)).alias("_joint"),
    )
    c1, c0 = F.col("_c1"), F.col("_c0")
    n = c1 + c0
    # Zero when one class or one bin is all there is.
    spread = F.greatest(F.col("_s1") / c1 + F.col("_s0") / c0 - 1, F.lit(0.0))
    phi2 = F.when((c1 > 0) & (c0 > 0) & (F.col("bins") > 1), spread).otherwise(0.0)
    information = F.col("_joint") / n - _xlog(c1 / n, c1 / n) - _xlog(c0 / n, c0 / n)
    return sums.select(
        "feature",
        n.cast("bigint").alias("n"),
        "bins",
        (n * phi2).alias("chi2"),
        F.sqrt(phi2).alias("cramer_v"),
        F.greatest(information, F.lit(0.0)).alias("mutual_information"),
    )


def _xlog(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.ln(y)).otherwise(0.0)


def chi_square(stats: DataFrame, top: int = KEPT_BY_CHI_SQUARE) -> DataFrame:
    """The ``top`` features by chi-square."""
    return stats.select("feature", "chi2").orderBy(F.desc("chi2"), F.asc("feature")).limit(top)


def cramers_v(stats: DataFrame) -> DataFrame:
    return stats.select("feature", "cramer_v", band("cramer_v", CRAMER_BANDS).alias("strength"))


def mutual_information(stats: DataFrame) -> DataFrame:
    return stats.select(
        "feature", "mutual_information", band("mutual_information", MUTUAL_BANDS).alias("strength")
    )


def forest_importance(
    train: DataFrame, features: list[str], target: str, labels: LabelTable | None = None, **forest
) -> DataFrame:
    """Information gain by random-forest importance. A text feature of ``labels``
    is worth the sum over its labels."""
    rows, texts = train.select(target, *features), labels is not None and any(c in labels.sizes for c in features)
    made = labels.features(rows, features) if texts else VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    model = RandomForestClassifier(featuresCol="features", labelCol=target, seed=SEED, **forest).fit(made)
    if texts:
        return label_importance(model.featureImportances, features, labels, "source")
    return importance_frame(train, model.featureImportances, features)


def label_importance(importances, features: list[str], labels: LabelTable, by: str) -> DataFrame:
    """(feature, importance) per place of a sparse vector, or summed ``by`` its
    source; only places that a tree splits on come to the driver and back."""
    some = [(int(i), float(x)) for i, x in zip(importances.indices, importances.values)]
    found = labels.spark.createDataFrame(some, "position int, importance double")
    named = labels.names(features).join(found, "position", "left").groupBy(F.col(by).alias("feature"))
    return named.agg(F.coalesce(F.sum("importance"), F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")


def importance_frame(df: DataFrame, importances, features: list[str]) -> DataFrame:
    """(feature, importance), greatest first; one row per model feature."""
    rows = sorted(zip(features, (float(x) for x in importances.toArray())), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


# Criteria. A report holds one row per feature, so its plain sorts and windows are small.


def _best_first(stat: str) -> list[Column]:
    return [F.desc(stat), F.asc("feature")]


def top_criterion(report: DataFrame, stat: str, top: int) -> DataFrame:
    return report.orderBy(*_best_first(stat)).limit(top)


def percentile_criterion(report: DataFrame, stat: str, percentile: float) -> DataFrame:
    """The best features that together reach ``percentile`` of the total; the
    one that crosses it is kept."""
    order = Window.partitionBy(F.lit(0)).orderBy(*_best_first(stat))
    before = F.coalesce(F.sum(stat).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum(stat).over(Window.partitionBy(F.lit(0)))
    return report.withColumn("_share", F.try_divide(before, total)).where(F.col("_share") < percentile).drop("_share")


def threshold_criterion(report: DataFrame, stat: str, threshold: float) -> DataFrame:
    return report.where(F.col(stat) > threshold)


def perc_criterion(report: DataFrame, stat: str, perc: float) -> DataFrame:
    """The best ``perc`` of the features, rounded up."""
    order = Window.partitionBy(F.lit(0))
    ranked = report.select(
        "*",
        F.row_number().over(order.orderBy(*_best_first(stat))).alias("_rank"),
        F.ceil(F.lit(perc) * F.count(F.lit(1)).over(order)).alias("_kept"),
    )
    return ranked.where(F.col("_rank") <= F.col("_kept")).drop("_rank", "_kept")


def choose_features(report: DataFrame, options: Options) -> list[str]:
    """Model features in report order. The chi-square report is already cut."""
    stats = {"infogain": "importance", "cramer": "cramer_v", "mtinfo": "mutual_information", "chisqrd": "chi2"}
    stat = stats[options.feat_mode]
    if options.feat_mode != "chisqrd":
        if options.criterion == "top":
            report = top_criterion(report, stat, options.top)
        elif options.criterion == "percentile":
            report = percentile_criterion(report, stat, options.percentile)
        elif options.criterion == "threshold":
            report = threshold_criterion(report, stat, options.threshold)
        else:
            report = perc_criterion(report, stat, options.perc)
    return [row["feature"] for row in report.orderBy(*_best_first(stat)).collect()]
