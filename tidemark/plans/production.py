"""Everything production scoring replays: cleaning, encoding and the model."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.model import model_columns
from tidemark.operators.scoring import score_buckets, score_logit, score_proba, with_run_stamp
from tidemark.options import Options
from tidemark.plans.clean import CleanPlan
from tidemark.plans.encode import EncodePlan
from tidemark.plans.labels import LabelTable
from tidemark.sources.lake import load_fitted, read_text, save_fitted, save_text
from tidemark.sources.staging import stage


@dataclass(frozen=True)
class ProductionPlan:
    """``chosen`` and ``labels`` are there for models with text features: the
    features in the order of training and the label table they were trained with."""

    clean: CleanPlan
    encode: EncodePlan
    model: PipelineModel
    chosen: tuple[str, ...] = ()
    labels: LabelTable | None = None

    def features(self, df: DataFrame) -> DataFrame:
        """The model's columns; those whose label the plan does not know are 0."""
        made = self.encode.dummies(self.clean.transform(df))
        wanted = self.chosen if self.labels else model_columns(self.model)
        absent = [c for c in wanted if c not in made.columns]
        made = made.withColumns({c: F.lit(0) for c in absent}) if absent else made
        return self.labels.features(made, list(self.chosen)) if self.labels else made

    def save(self, spark: SparkSession, path: str) -> None:
        save_text(spark, self.clean.to_json(), f"{path}/clean")
        save_text(spark, self.encode.to_json(), f"{path}/encode")
        save_fitted(self.model, f"{path}/model")
        save_text(spark, json.dumps(self.chosen if self.labels else []), f"{path}/chosen")
        if self.labels:
            self.labels.save(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ProductionPlan:
        chosen = tuple(json.loads(read_text(spark, f"{path}/chosen")))
        return cls(
            CleanPlan.from_json(read_text(spark, f"{path}/clean")),
            EncodePlan.from_json(read_text(spark, f"{path}/encode")),
            load_fitted(PipelineModel, f"{path}/model"),
            chosen,
            LabelTable.load(spark, f"{path}/labels") if chosen else None,
        )


def score_production(candidates: DataFrame, plan: ProductionPlan, options: Options, stamp: str | None = None) -> DataFrame:
    """Raw merged candidates to score, alternative score, bucket and run stamp."""
    s = options.spine
    predicted = plan.model.transform(plan.features(candidates))
    keep = [c for c in s.all() if c in candidates.columns]
    scored = score_logit(score_proba(predicted, options.score_col)).select(
        *keep, "probability", "rawPrediction", "prediction", options.score_col, "score_alt"
    )
    # Ranking samples its input before it shuffles; staged, the model runs once.
    bucketed = score_buckets(
        stage(scored, "scored"),
        options.score_col,
        [s.id] if s.id in keep else [s.date, s.ident],
        buckets=options.eval_buckets,
        error=options.eval_error,
        name=options.buckets_name,
    )
    return with_run_stamp(bucketed, "exec_time", stamp)
