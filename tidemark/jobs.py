"""The monthly jobs, each reading and writing catalog tables.

    spine -> clean (per source) -> merge -> select -> train -> score -> assess
    refit -> produce -> evaluate, and audits per split

A job takes the session and a ``Setup`` and hands its result over as a
versioned table, a CSV report or a saved plan, as the next job expects it.
"""

from __future__ import annotations

import argparse
import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import month_window, stamp_text
from tidemark.operators import audit, evaluation, merge, model, reports, scoring, selection, state
from tidemark.operators import spine as spines
from tidemark.operators.profile import numeric_columns, string_columns
from tidemark.options import Options
from tidemark.plans.clean import CleanPlan, fit_clean, tidy, trimmed
from tidemark.plans.encode import EncodePlan, fit_by_width, fit_encode
from tidemark.plans.labels import LabelTable, merged
from tidemark.plans.production import ProductionPlan, score_production
from tidemark.plans.split import fit_split
from tidemark.sources import lake
from tidemark.sources.staging import clear_staged, stage

SPLITS = ("train", "test", "val")
REPORT_SCHEMAS = {
    "infogain": "feature string, importance double",
    "chisqrd": "feature string, chi2 double",
    "cramer": "feature string, cramer_v double, strength string",
    "mtinfo": "feature string, mutual_information double, strength string",
}
METRICS_SCHEMA = "metric_name string, train double, test double, val double"


@dataclass(frozen=True)
class Setup:
    """One job configuration. ``sources`` maps ``spine``, ``spine_prod``,
    ``clean_0``, ... to tables; ``tables`` maps outputs to base names."""

    options: Options
    schema: str
    sources: dict[str, str]
    tables: dict[str, str]
    folder: str
    window: tuple[str, str] = ("1970-01-01", "%Y-%m-%d")
    months: int = 0
    source_keys: tuple[str, str] | None = None
    source_date: str = "date_part"
    buckets: int | None = None
    alias: str = ""
    stamp: str = field(default_factory=stamp_text)

    @classmethod
    def from_config(cls, config: dict) -> Setup:
        return cls(
            options=Options.from_config(config),
            schema=config["schema"],
            sources=config["table_sources"],
            tables=config["table_outputs"],
            folder=config.get("folder") or config["prod_path"].rstrip("/").removesuffix("/prod"),
            window=tuple(config["ini_date"]),
            months=config.get("qty_months", 0),
            source_keys=tuple(config["source_keys"]) if "source_keys" in config else None,
            source_date=config.get("source_date", "date_part"),
            buckets=config.get("buckets"),
            alias=config.get("alias") or "",
        )

    def path(self, *parts: str) -> str:
        return "/".join((self.folder, *parts))

    def own(self, *parts: str) -> str:
        """The path of an output that every alias (parameter set) has for itself."""
        return self.path(*parts) + (f"_{self.alias}" if self.alias else "")

    def bounds(self):
        return month_window(*self.window, months=self.months)

    def save(self, df: DataFrame, output: str) -> str:
        """A new version; with ``buckets`` the tables that are merged later are
        bucketed by their keys instead of partitioned, and merge without a shuffle."""
        base, options = self.tables[output], self.options
        if self.buckets and (output == "spine" or output.startswith("clean")):
            return lake.save_versioned(
                df, self.schema, base, self.stamp, bucket_by=(self.buckets, options.spine.keys)
            )
        # A partitioned write is rebalanced, which would undo a fixed count.
        if options.n_part and not options.new_part_cols:
            df = spines.redistribute(df, options.n_part)
        return lake.save_versioned(df, self.schema, base, self.stamp, options.new_part_cols)

    def read(self, spark: SparkSession, output: str) -> DataFrame:
        return lake.read_latest(spark, self.schema, self.tables[output])

    def raw_source(self, spark: SparkSession, name: str) -> merge.Source:
        ident, date = self.source_keys or (self.options.spine.ident, self.source_date)
        return merge.Source(spark.read.table(self.sources[name]).drop(*self.options.feat_drop), ident, date)

    def raw_sources(self, spark: SparkSession) -> list[merge.Source]:
        return [self.raw_source(spark, name) for name in numbered(self.sources)]


def numbered(names) -> list[str]:
    """``clean_0``, ``clean_1``, ... in the order of their numbers."""
    return sorted((k for k in names if k.startswith("clean")), key=lambda k: (len(k), k))


def build_spine(spark: SparkSession, setup: Setup) -> str:
    """Candidates of the window to an identified, split and sampled spine."""
    s = setup.options.spine
    rows = lake.scan_window(spark.read.table(setup.sources["spine"]), setup.source_date, *setup.bounds())
    rows = spines.cast_target(rows, s.target)
    if s.date not in rows.columns:
        rows = rows.withColumn(s.date, F.col(setup.source_date).cast("date"))
    rows = spines.with_id(rows.select(s.ident, s.date, s.target), s)
    plan = fit_split(rows, setup.options)
    train = spines.split_rows(plan.assign(rows), s, "train")
    lake.save_report(spines.prior_report(train, plan.sample(train), s), setup.path("prior"))
    return setup.save(plan.transform(rows).select(*s.all()), "spine")


def clean_source(spark: SparkSession, setup: Setup, index: int) -> str:
    """One raw source on the spine: cleaned, encoded, saved with its plans. Text
    columns of more than ``max_labels`` labels stay text and get a label table."""
    options, s = setup.options, setup.options.spine
    source = setup.raw_source(spark, f"clean_{index}")
    raw = merge.merge_windowed(setup.read(spark, "spine"), [source], (s.ident, s.date), *setup.bounds())
    rows = stage(raw, "raw")
    profile_source(spark, setup, index, rows)
    cleaner = fit_clean(rows, options, low_variance=options.low_variance)
    cleaned = cleaner.transform(rows)
    encoder, labels = fit_by_width(
        spines.split_rows(cleaned, s, "train"), string_columns(cleaned, s.all()), options.max_labels
    )
    labels.save(setup.path("plans", f"labels_{index}"))
    lake.save_text(spark, cleaner.to_json(), setup.path("plans", f"clean_{index}"))
    lake.save_text(spark, encoder.to_json(), setup.path("plans", f"encode_{index}"))
    return setup.save(encoder.dummies(cleaned), f"clean_{index}")


def profile_source(spark: SparkSession, setup: Setup, index: int, rows: DataFrame) -> DataFrame:
    """The profile of a source over all its periods, as a report. The state per
    period is kept as a table: periods profiled by an earlier run are not read."""
    options, s = setup.options, setup.options.spine
    columns = [c for c in rows.columns if c not in s.all()]
    # States of other columns or of another error cannot be merged with these.
    kind = hashlib.sha256(json.dumps([sorted(columns), options.rsd]).encode()).hexdigest()[:8]
    kept = state.keep_state(
        spark, f"{setup.schema}.profile_{setup.tables[f'clean_{index}']}_{kind}", tidy(rows, s.all()), s.date, columns, options.rsd
    )
    periods = rows.select(F.col(s.date).alias("_period")).distinct()
    known = kept.join(F.broadcast(periods), F.col("period").eqNullSafe(F.col("_period")), "left_semi")
    report = state.merge_state(known)
    lake.save_report(report, setup.path("profile", f"clean_{index}"))
    return report


def merge_sources(spark: SparkSession, setup: Setup) -> str:
    """All cleaned sources on the spine; in PROD mode the parts are dropped
    once the merged table has rows."""
    s = setup.options.spine
    outputs = numbered(setup.tables)
    tables = [setup.read(spark, k) for k in outputs]
    name = setup.save(merge.merge_cleaned(setup.read(spark, "spine"), tables, s.all(), s.keys), "dataset")
    if setup.options.mode == "PROD":
        parts = [f"{setup.schema}.{lake.latest_version(spark, setup.schema, setup.tables[k])}" for k in outputs]
        lake.drop_if_written(spark, name, parts)
    return name


def select_features(spark: SparkSession, setup: Setup, method: str) -> DataFrame:
    """One feature report on the train rows, saved as CSV."""
    if method != "infogain":
        return select_associations(spark, setup, (method,))[method]
    s = setup.options.spine
    train = spines.split_rows(setup.read(spark, "dataset"), s, "train")
    labels = saved_labels(spark, setup)
    features = [*numeric_columns(train, s.all()), *labels.sizes]
    report = selection.forest_importance(train, features, s.target, labels)
    lake.save_report(report, setup.path("feat_sel", method))
    return report


def select_associations(
    spark: SparkSession, setup: Setup, methods: tuple[str, ...] = ("chisqrd", "cramer", "mtinfo")
) -> dict[str, DataFrame]:
    """The reports that rest on contingency counts, from one staged count.

    Binary features take part in mutual information only.
    """
    options, s = setup.options, setup.options.spine
    train = spines.split_rows(setup.read(spark, "dataset"), s, "train")
    features = [*numeric_columns(train, s.all()), *saved_labels(spark, setup).sizes]
    binary = binary_features(spark, setup)
    if "mtinfo" not in methods:
        features = [c for c in features if c not in binary]
    counted = selection.association(train, features, s.target, options.bin_buckets, options.bin_error)
    stats = stage(counted, "association")
    wider = stats.where(~F.col("feature").isin(sorted(binary))) if binary else stats
    found = {}
    for method in methods:
        if method == "mtinfo":
            found[method] = selection.mutual_information(stats)
        elif method == "cramer":
            found[method] = selection.cramers_v(wider)
        else:
            found[method] = selection.chi_square(wider, options.num_top_features)
        lake.save_report(found[method], setup.path("feat_sel", method))
    return found


def binary_features(spark: SparkSession, setup: Setup) -> set[str]:
    """0/1 features, known from the saved plans without another scan."""
    found: set[str] = set()
    for cleaner, encoder in saved_plans(spark, setup):
        found |= {*cleaner.binary, *cleaner.plain_binary, *encoder.dummy_sources()}
    return found


def saved_plans(spark: SparkSession, setup: Setup) -> list[tuple[CleanPlan, EncodePlan]]:
    indices = [k.removeprefix("clean_") for k in numbered(setup.tables)]
    return [
        (
            CleanPlan.from_json(lake.read_text(spark, setup.path("plans", f"clean_{i}"))),
            EncodePlan.from_json(lake.read_text(spark, setup.path("plans", f"encode_{i}"))),
        )
        for i in indices
    ]


def saved_labels(spark: SparkSession, setup: Setup) -> LabelTable:
    """The label tables of all sources as one."""
    indices = [k.removeprefix("clean_") for k in numbered(setup.tables)]
    return merged([LabelTable.load(spark, setup.path("plans", f"labels_{i}")) for i in indices])


def train(spark: SparkSession, setup: Setup, **size) -> str:
    """Chosen features, boosted trees, predictions of all splits."""
    options, s = setup.options, setup.options.spine
    method = options.feat_mode
    report = lake.read_report(spark, setup.path("feat_sel", method), REPORT_SCHEMAS[method])
    features = selection.choose_features(report, options)
    lake.save_features(spark, features, setup.own("feat_sel", "chosen"))
    rows = setup.read(spark, "dataset").select(*s.all(), *features)
    labels = saved_labels(spark, setup)
    fitted = model.train_gbt(spines.split_rows(rows, s, "train"), features, s.target, labels, **size)
    lake.save_fitted(fitted, setup.own("model"))
    return setup.save(model.predict(fitted, rows, s.all(), features, labels), "pred")


def score(spark: SparkSession, setup: Setup) -> str:
    options, s = setup.options, setup.options.spine
    base = lake.latest_version(spark, setup.schema, setup.tables["pred"])
    rows = scoring.score_logit(scoring.score_proba(spark.read.table(f"{setup.schema}.{base}"), options.score_col))
    bucketed = scoring.score_buckets(
        rows, options.score_col, [s.id], [s.ind_split], options.eval_buckets, options.eval_error, options.buckets_name
    )
    name = setup.save(bucketed, "score")
    lake.drop_if_written(spark, name, [f"{setup.schema}.{base}"])
    return name


def assess(spark: SparkSession, setup: Setup) -> None:
    """Importances, metrics and KS tables as CSV reports."""
    options, s = setup.options, setup.options.spine
    rows = setup.read(spark, "score")
    fitted = lake.load_fitted(PipelineModel, setup.own("model"))
    chosen = lake.read_features(spark, setup.own("feat_sel", "chosen"))
    importances = model.gbt_importance(fitted, rows, chosen, saved_labels(spark, setup))
    lake.save_report(importances, setup.own("feat_import"))
    report = evaluation.metrics_report(rows, s.target, options.score_col, split=s.ind_split, splits=SPLITS)
    lake.save_report(report, setup.own("metrics"))
    by_split = evaluation.ks_table(rows, s.target, options.score_col, options.buckets_name, [s.ind_split])
    lake.save_report(by_split.where(F.col(s.ind_split) != "val"), setup.own("ks"))
    by_month = evaluation.ks_by_period(
        spines.split_rows(rows, s, "val"), s.target, options.score_col, [s.id], s.date,
        options.eval_buckets, options.eval_error,
    )
    lake.save_report(by_month, setup.own("ks_val"))


def refit(spark: SparkSession, setup: Setup) -> None:
    """Labels refitted on the sources behind the chosen features over the whole
    window, saved with the model as production's plan.

    Two-valued columns keep the pair they were trained on, or their 0 and 1 could
    change sides, and columns with a label table keep the places in the model's
    vector. Model columns whose label no longer occurs are 0 in production.
    """
    options, s = setup.options, setup.options.spine
    chosen = lake.read_features(spark, setup.own("feat_sel", "chosen"))
    plans = saved_plans(spark, setup)
    cleaner = CleanPlan(
        tuple(s.all()),
        tuple(c for p, _ in plans for c in p.columns),
        binary={c: v for p, _ in plans for c, v in p.binary.items()},
        plain_binary=tuple(c for p, _ in plans for c in p.plain_binary),
        bin_input=options.bin_input,
    )
    trained = EncodePlan({c: v for _, e in plans for c, v in e.labels.items()})
    needed = trained.original_features(chosen)
    raw = merge.merge_windowed(
        setup.read(spark, "spine"), setup.raw_sources(spark), (s.ident, s.date), *setup.bounds(), keep=needed
    )
    cleaner = cleaner.only(needed)
    cleaned = cleaner.transform(raw)
    labels = saved_labels(spark, setup).only(needed)
    encoder = fit_encode(cleaned, string_columns(cleaned, [*s.all(), *labels.sizes]))
    fitted = lake.load_fitted(PipelineModel, setup.own("model"))
    plan = ProductionPlan(cleaner, encoder, fitted, tuple(chosen), labels if labels.sizes else None)
    plan.save(spark, setup.own("production"))


def produce(spark: SparkSession, setup: Setup, today: str) -> str:
    """Scores the month three back and appends it to the score history, once for
    a day and alias: a second try of the same job adds nothing."""
    options, s = setup.options, setup.options.spine
    start, end = month_window(today, "%Y-%m-%d", first_offset=-3)
    name, run = f"{setup.schema}.{setup.tables['prod']}", f"{setup.alias or 'run'}-{today}"
    if run in lake.committed_runs(spark, name):
        return name
    plan = ProductionPlan.load(spark, setup.own("production"))
    people = lake.scan_window(spark.read.table(setup.sources["spine_prod"]), setup.source_date, start, end)
    if s.date not in people.columns:
        people = people.withColumn(s.date, F.col(setup.source_date).cast("date"))
    rows = merge.merge_windowed(
        people.select(s.ident, s.date), setup.raw_sources(spark), (s.ident, s.date), start, end, keep=plan.clean.columns
    )
    scored = score_production(rows, plan, options, setup.stamp)
    lake.append_run(scored, name, run, options.new_part_cols)
    return name


def evaluate(spark: SparkSession, setup: Setup, outcomes: str) -> None:
    """Last production scores against known outcomes."""
    options, s = setup.options, setup.options.spine
    known = merge.join_outcomes(
        lake.last_slice(spark, f"{setup.schema}.{setup.tables['prod']}", s.date),
        spark.read.table(outcomes).select(s.ident, F.col(s.date).cast("date").alias(s.date), s.target),
        s.keys,
    )
    metrics = evaluation.metrics_report(known, s.target, options.score_col)
    lake.save_report(metrics, setup.own("prod", "metrics"))
    lake.save_report(
        evaluation.ks_table(known, s.target, options.score_col, options.buckets_name), setup.own("prod", "ks")
    )


def audit_split(spark: SparkSession, setup: Setup, split: str) -> None:
    """Numeric and categorical drift audits of the raw sources behind the chosen features."""
    s = setup.options.spine
    chosen = lake.read_features(spark, setup.own("feat_sel", "chosen"))
    labels = EncodePlan({c: v for _, e in saved_plans(spark, setup) for c, v in e.labels.items()})
    needed = labels.original_features(chosen)
    base = spines.split_rows(setup.read(spark, "spine"), s, split).select(*s.keys)
    merged = merge.merge_windowed(base, setup.raw_sources(spark), (s.ident, s.date), *setup.bounds(), keep=needed)
    rows = stage(merged, "audit")
    numbers, texts = numeric_columns(rows, s.all()), string_columns(rows, s.all())
    if numbers:
        found = audit.audit_numeric(rows, s.date, numbers, setup.options.eval_error)
        lake.save_large_report(found, setup.own("audit", f"num_{split}"))
    if texts:
        found = audit.audit_categorical(trimmed(rows, s.all()), s.date, texts)
        lake.save_large_report(found, setup.own("audit", f"cat_{split}"))


def merge_reports(spark: SparkSession, setup: Setup) -> tuple[DataFrame, DataFrame]:
    """The feature-selection and performance reports as two long tables."""
    s = setup.options.spine
    found = {m: lake.read_if_present(spark, setup.path("feat_sel", m), shape) for m, shape in REPORT_SCHEMAS.items()}
    features = reports.feature_selection_report(found["infogain"], found["chisqrd"], found["cramer"], found["mtinfo"])
    ks_columns = ", ".join(f"{c} {'bigint' if c in ('n', 'positives', 'negatives') else 'double'}" for c in evaluation.KS_COLUMNS[1:])
    performance = reports.performance_report(
        lake.read_report(spark, setup.own("metrics"), METRICS_SCHEMA),
        lake.read_report(spark, setup.own("feat_import"), REPORT_SCHEMAS["infogain"]),
        lake.read_report(spark, setup.own("ks"), f"{s.ind_split} string, decile int, {ks_columns}"),
        lake.read_report(spark, setup.own("ks_val"), f"{s.date} date, decile int, {ks_columns}"),
        s.ind_split,
        s.date,
    )
    lake.save_report(features, setup.path("report_features"))
    lake.save_report(performance, setup.own("report_performance"))
    return features, performance


def main(argv: list[str] | None = None) -> None:
    """``spark-submit ... -m tidemark.jobs <job> -c config.json [argument]``"""
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("-c", "--config", default="config.json")
    parser.add_argument("argument", nargs="?", help="source index, method, split, day or outcome table")
    args = parser.parse_args(argv)
    setup = Setup.from_config(json.loads(Path(args.config).read_text(encoding="utf-8")))
    spark = SparkSession.builder.appName(f"tidemark_{args.job}").getOrCreate()
    job, convert = JOBS[args.job]
    if convert is not None and args.argument is None:
        parser.error(f"{args.job} needs its argument")
    try:
        job(spark, setup, *([convert(args.argument)] if convert else []))
    finally:
        clear_staged(spark)


JOBS = {
    "spine": (build_spine, None),
    "clean": (clean_source, int),
    "merge": (merge_sources, None),
    "select": (select_features, str),
    "associate": (select_associations, None),
    "train": (train, None),
    "score": (score, None),
    "assess": (assess, None),
    "refit": (refit, None),
    "produce": (produce, str),
    "evaluate": (evaluate, str),
    "audit": (audit_split, str),
    "reports": (merge_reports, None),
}

if __name__ == "__main__":
    main()
