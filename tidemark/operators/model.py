"""Gradient-boosted trees on chosen features.

Numbers are assembled by a stage of the fitted pipeline. With text features the
caller hands in their label table, and the vector is made by that, sparse.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.selection import SEED, importance_frame, label_importance
from tidemark.options import SpineColumns
from tidemark.plans.labels import LabelTable
from tidemark.sources.staging import shared_folder

# The model size.
MODEL_SIZE = {"maxDepth": 5, "maxBins": 32, "maxIter": 50, "stepSize": 0.1}
WEIGHT = "_equal_rows"
# More train rows than these are binned before equal ones are put together.
BINNED_FROM = 500_000


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def train_gbt(
    train: DataFrame, features: list[str], target: str, labels: LabelTable | None = None, **size
) -> PipelineModel:
    """Assembler and boosted trees, or the trees alone if some features are text.
    A checkpoint folder is named first: boosting then cuts its lineage every few trees.

    Boosting reads its rows once per level of every tree, so equal rows are read as
    one that weighs as much as all of them, unless ``size`` asks for a share or a
    number of rows. Each core gets one even part: every level waits for the last.

    Trees split a number in ``maxBins`` bins at most, and find the places for that on
    some 10,000 rows. Of more than ``BINNED_FROM`` rows the places are quantiles of all
    of them, and numbers become their bins in a first stage of the pipeline: far more
    rows are then equal, and the trees lose no split.
    """
    shared_folder(train.sparkSession)
    trees = GBTClassifier(labelCol=target, featuresCol="features", seed=SEED, **(MODEL_SIZE | size))
    rows = train.select(target, *features)
    weighed = trees.getSubsamplingRate() == 1 and trees.getMinInstancesPerNode() == 1
    if weighed:
        trees.setWeightCol(WEIGHT)
    if has_texts(features, labels):
        rows = _weighed(rows) if weighed else rows
        return PipelineModel([trees.fit(_spread(labels.features(rows, features), target))])
    stages = []
    if weighed and rows.count() > BINNED_FROM:
        stages, rows = _binned(rows, target, features, trees.getMaxBins())
    assembler = VectorAssembler(inputCols=rows.columns[1:], outputCol="features")
    rows = _weighed(rows) if weighed else rows
    return PipelineModel([*stages, assembler, trees.fit(_spread(assembler.transform(rows), target))])


def _binned(rows: DataFrame, target: str, features: list[str], bins: int) -> tuple[list[Bucketizer], DataFrame]:
    """A stage that puts wide numbers in bins, if there are any, and the rows with its
    columns in place of theirs. Whole numbers in a range of ``bins`` are bins already."""
    kinds = {f.name: f.dataType for f in rows.schema if f.name in features}
    whole = [c for c, kind in kinds.items() if isinstance(kind, T.IntegralType)]
    ends = [(F.max(_quoted(c)).cast("double") - F.min(_quoted(c))).alias(f"_{i}") for i, c in enumerate(whole)]
    spans = dict(zip(whole, rows.agg(*ends).first())) if whole else {}
    wide = [c for c, kind in kinds.items() if isinstance(kind, T.NumericType) and (spans.get(c, bins) or 0) >= bins]
    if not wide:
        return [], rows
    shares = [k / bins for k in range(1, bins)]
    sketches = [F.percentile_approx(F.col(_quoted(c)).cast("double"), shares, 100 * bins) for c in wide]
    found = rows.agg(*[sketch.alias(f"_{i}") for i, sketch in enumerate(sketches)]).first()
    # A bin ends after its cut, so a value that many rows share ends one.
    cuts = {c: sorted({math.nextafter(x, math.inf) for x in edges or [] if not math.isnan(x)}) for c, edges in zip(wide, found)}
    splits = {c: [-math.inf, *filter(math.isfinite, edges), math.inf] for c, edges in cuts.items()}
    splits = {c: edges for c, edges in splits.items() if len(edges) > 2}
    if not splits:
        return [], rows
    names = {c: f"_bin_{i}" for i, c in enumerate(splits)}
    stage = Bucketizer(inputCols=list(splits), outputCols=list(names.values()), splitsArray=list(splits.values()))

    def placed(c: str) -> Column:
        # A plain integer, or the trees would take bins for categories without order.
        # Infinities have none, so that they are refused as if there were no bins.
        finite = F.abs(F.col(_quoted(c)).cast("double")) < math.inf
        return F.when(finite, F.col(names[c]).cast("int")).alias(names[c]) if c in names else F.col(_quoted(c))

    return [stage], stage.transform(rows).select(target, *map(placed, features))


def _quoted(name: str) -> str:
    return f"`{name}`"


def model_columns(model: PipelineModel) -> list[str]:
    """The columns that an assembled model reads, in the order of its vector."""
    made = {out: c for s in model.stages if isinstance(s, Bucketizer) for c, out in zip(s.getInputCols(), s.getOutputCols())}
    return [made.get(c, c) for c in model.stages[-2].getInputCols()]


def _weighed(rows: DataFrame) -> DataFrame:
    """Each different row once, with the number of its equals. One struct is
    grouped, as a method with a key per feature grows too long to be compiled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    return rows.groupBy(whole).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)).select("_row.*", WEIGHT)


def _spread(vectors: DataFrame, target: str) -> DataFrame:
    kept = [c for c in (target, "features", WEIGHT) if c in vectors.columns]
    return vectors.select(*kept).repartition(vectors.sparkSession.sparkContext.defaultParallelism)


def has_texts(features: list[str], labels: LabelTable | None) -> bool:
    return labels is not None and any(c in labels.sizes for c in features)


def predict(
    model: PipelineModel, df: DataFrame, keep: list[str], features: list[str] = (), labels: LabelTable | None = None
) -> DataFrame:
    """``keep`` plus probability, rawPrediction and prediction."""
    if has_texts(features, labels):
        df = labels.features(df, features)
    scored = model.transform(df)
    return scored.select(*keep, "probability", "rawPrediction", "prediction")


def spine_of(df: DataFrame, spine: SpineColumns) -> list[str]:
    return [c for c in spine.all() if c in df.columns]


def gbt_importance(
    model: PipelineModel, df: DataFrame, features: list[str] = (), labels: LabelTable | None = None
) -> DataFrame:
    trees = model.stages[-1]
    assert isinstance(trees, GBTClassificationModel)
    if has_texts(features, labels):
        return label_importance(trees.featureImportances, features, labels, "feature")
    return importance_frame(df, trees.featureImportances, model_columns(model))
