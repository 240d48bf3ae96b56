"""Category encoding: labels fitted on train rows, replayed everywhere."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.profile import value_counts
from tidemark.plans.labels import LabelTable, none, rank_labels
from tidemark.sources.staging import stage

# Columns that a frame can get, one for each label.
MOST_DUMMIES = 20_000


@dataclass(frozen=True)
class EncodePlan:
    """Labels per column, most frequent first, ties in label order."""

    labels: dict[str, tuple[str, ...]]

    def indexer(self, suffix: str = "_idx") -> PipelineModel:
        """Index from 0 by frequency; unseen labels get the last index."""
        return PipelineModel(
            [
                StringIndexerModel.from_labels(list(labels), inputCol=c, outputCol=c + suffix, handleInvalid="keep")
                for c, labels in self.labels.items()
            ]
        )

    def encoder(self, sample: DataFrame) -> PipelineModel:
        """Indexers and one-hot encoder as one saveable object. Category sizes
        come from the indexers' metadata, so fitting reads no rows."""
        indexer = self.indexer()
        columns = list(self.labels)
        one_hot = OneHotEncoder(
            inputCols=[c + "_idx" for c in columns], outputCols=[c + "_ohe" for c in columns], handleInvalid="keep"
        )
        return PipelineModel([*indexer.stages, one_hot.fit(indexer.transform(sample))])

    def dummy_sources(self) -> dict[str, str]:
        """Dummy column -> source column."""
        return {f"{c}_{label}": c for c, labels in self.labels.items() for label in labels}

    def dummies(self, df: DataFrame) -> DataFrame:
        """Source columns replaced by one 0/1 column per label."""
        kept = [c for c in df.columns if c not in self.labels]
        names = [n.lower() for n in kept] + [f"{c}_{label}".lower() for c, v in self.labels.items() for label in v]
        if len(set(names)) < len(names):
            raise ValueError(f"dummy columns collide: {sorted({n for n in names if names.count(n) > 1})}")
        flags = [
            F.col(c).eqNullSafe(F.lit(label)).cast("int").alias(f"{c}_{label}")
            for c, labels in self.labels.items()
            for label in labels
        ]
        return df.select(*kept, *flags)

    def original_features(self, features: list[str]) -> list[str]:
        """Source columns behind model features, each once."""
        sources = self.dummy_sources()
        return list(dict.fromkeys(sources.get(f, f) for f in features))

    def only(self, columns: list[str]) -> EncodePlan:
        return EncodePlan({c: v for c, v in self.labels.items() if c in columns})

    def to_json(self) -> str:
        return json.dumps(self.labels)

    @classmethod
    def from_json(cls, text: str) -> EncodePlan:
        return cls({c: tuple(v) for c, v in json.loads(text).items()})


def fit_encode(train: DataFrame, columns: list[str], max_labels: int | None = None) -> EncodePlan:
    """Every label of ``columns`` is kept, as a column each. More than
    ``max_labels`` in one column, or ``MOST_DUMMIES`` in all, is an error: label
    tables hold such columns."""
    if not columns:
        return EncodePlan({})
    counts = stage(value_counts(train, columns).where(F.col("value").isNotNull()), "labels")
    sizes = _sizes(counts, columns)
    wide = [] if max_labels is None else [c for c, n in sizes.items() if n > max_labels]
    if wide:
        raise ValueError(f"more than {max_labels} labels in {wide}; drop, group or index them instead of encoding")
    return _collected(counts, sizes)


def fit_by_width(train: DataFrame, columns: list[str], widest: int) -> tuple[EncodePlan, LabelTable]:
    """A plan for the columns of at most ``widest`` labels and a label table for the others."""
    if not columns:
        return EncodePlan({}), none(train.sparkSession)
    counts = stage(value_counts(train, columns), "labels")
    sizes = _sizes(counts.where(F.col("value").isNotNull()), columns)
    wide = [c for c, n in sizes.items() if n > widest]
    narrow = {c: n for c, n in sizes.items() if c not in wide}
    plan = _collected(counts.where(F.col("value").isNotNull()), narrow)
    return plan, rank_labels(counts, wide) if wide else none(train.sparkSession)


def _sizes(counts: DataFrame, columns: list[str]) -> dict[str, int]:
    found = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in columns}


def _collected(counts: DataFrame, sizes: dict[str, int]) -> EncodePlan:
    """The labels of ``sizes`` by name, at most ``MOST_DUMMIES``: each becomes a column."""
    if sum(sizes.values()) > MOST_DUMMIES:
        raise ValueError(f"{sum(sizes.values())} labels in {list(sizes)} are too many columns")
    found: dict[str, list] = {c: [] for c in sizes}
    for row in sorted(counts.where(F.col("column").isin(list(sizes))).collect(), key=lambda r: (-r["n"], r["value"])):
        found[row["column"]].append(row["value"])
    return EncodePlan({c: tuple(v) for c, v in found.items()})
