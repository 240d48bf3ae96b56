"""Feature ranking, criteria and report merges."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scores import CRAMER_BANDS, MUTUAL_BANDS
from tidemark.operators import evaluation, reports, selection
from tidemark.operators.spine import resample
from tidemark.plans.clean import fill_nulls
from tidemark.plans.encode import fit_encode
from tidemark.sources.staging import stage
from workloads import scoring
from workloads.fixtures import KEYS, NUMERIC, OPTIONS, SPINE, TEXT, rounded, split_dataset, with_deciles
from workloads.sql import key_hash, query

FEATURES = [*NUMERIC, *TEXT]


def train_rows(spark, sf_dir):
    rows = split_dataset(spark, sf_dir).where("ind_split = 'train'")
    return stage(rows.select(*KEYS, "target", *FEATURES))


def stats(spark, sf_dir, resampled=False):
    rows = train_rows(spark, sf_dir)
    if resampled:
        rows = resample(rows, 0.5, SPINE)
    return selection.association(rows, FEATURES, "target")


def quantile_buckets(spark, sf_dir):
    return selection.quantile_buckets(train_rows(spark, sf_dir).select(*KEYS, *NUMERIC), NUMERIC)


def quantile_cuts(spark, sf_dir):
    cuts = selection.quantile_cuts(train_rows(spark, sf_dir), NUMERIC)
    return cuts.select("feature", F.posexplode("cuts").alias("i", "cut"))


def chi_square(spark, sf_dir):
    return rounded(selection.chi_square(stats(spark, sf_dir)))


def cramers_v(spark, sf_dir):
    return rounded(selection.cramers_v(stats(spark, sf_dir)))


def cramers_v_resampled(spark, sf_dir):
    return rounded(selection.cramers_v(stats(spark, sf_dir, resampled=True)))


def mutual_information(spark, sf_dir):
    return rounded(selection.mutual_information(stats(spark, sf_dir)))


def _report(spark, sf_dir):
    return rounded(selection.mutual_information(stats(spark, sf_dir))).select("feature", "mutual_information")


def criterion_top(spark, sf_dir):
    return selection.top_criterion(_report(spark, sf_dir), "mutual_information", 4)


def criterion_percentile(spark, sf_dir):
    return selection.percentile_criterion(_report(spark, sf_dir), "mutual_information", OPTIONS.percentile)


def criterion_threshold(spark, sf_dir):
    return selection.threshold_criterion(_report(spark, sf_dir), "mutual_information", 0.0005)


def criterion_perc(spark, sf_dir):
    return selection.perc_criterion(_report(spark, sf_dir), "mutual_information", OPTIONS.perc)


def feature_importance_rf(spark, sf_dir):
    """A row per feature, dummies of all text columns included; the importances are shares of one."""
    rows = stage(fill_nulls(train_rows(spark, sf_dir), SPINE.all()))
    encoded = stage(fit_encode(rows, TEXT).dummies(rows))
    features = [c for c in encoded.columns if c not in SPINE.all()]
    return importance_facts(selection.forest_importance(encoded, features, "target"))


def importance_facts(report):
    """What holds for every fit: the features, each importance a share, and their sum."""
    total = F.sum("importance").over(Window.partitionBy(F.lit(0)))
    return report.select(
        "feature",
        F.col("importance").between(0, 1).alias("is_share"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
    )


def report_feature_selection(spark, sf_dir):
    found = stage(stats(spark, sf_dir))
    merged = reports.feature_selection_report(
        chi_square=selection.chi_square(found),
        cramer=selection.cramers_v(found),
        mutual=selection.mutual_information(found),
    )
    return rounded(merged)


def report_performance(spark, sf_dir):
    rows = stage(with_deciles(spark, sf_dir))
    merged = reports.performance_report(
        evaluation.metrics_report(rows, "target", "p", split="ind_split"),
        None,
        evaluation.ks_table(rows, "target", "p", groups=["ind_split"]),
        evaluation.ks_by_period(rows.where("ind_split = 'val'"), "target", "p", ["ident"], "month"),
        "ind_split",
        "month",
    )
    return rounded(merged)


def chosen_by_cramer(spark, sf_dir):
    """Criterion and report order as training uses them."""
    report = rounded(selection.cramers_v(stats(spark, sf_dir)))
    chosen = selection.choose_features(report, replace(OPTIONS, feat_mode="cramer", criterion="top", top=5))
    rows = list(enumerate(chosen))
    return spark.createDataFrame(rows, "position int, feature string")


QUERIES = {
    "feature_importance_rf": feature_importance_rf,
    "quantile_cuts": quantile_cuts,
    "quantile_buckets": quantile_buckets,
    "chi_square": chi_square,
    "cramers_v": cramers_v,
    "cramers_v_resampled": cramers_v_resampled,
    "mutual_information": mutual_information,
    "criterion_top": criterion_top,
    "criterion_percentile": criterion_percentile,
    "criterion_threshold": criterion_threshold,
    "criterion_perc": criterion_perc,
    "chosen_features": chosen_by_cramer,
    "report_feature_selection": report_feature_selection,
    "report_performance": report_performance,
}


TIDY_LABEL = "regexp_replace(replace(upper(trim({c})), ' ', '_'), '[^A-Za-z0-9_]', '', 'g')"


def importance_query(label: str) -> str:
    """The model columns: numbers by name, texts by their labels in the train rows."""
    labels = [
        f"select distinct '{c}_' || coalesce({label.format(c=c)}, 'SIN_INFO') from split_dataset where ind_split = 'train'"
        for c in TEXT
    ]
    names = " union all ".join([f"select unnest({NUMERIC}) as feature", *labels])
    return query(f"select feature, true as is_share, true as sums_to_one from ({names})", "split_dataset")


def _cuts(c: str) -> str:
    """Distinct quintiles; at the maximum, the greatest smaller value instead."""
    below = f"(select max({c}) from tr where {c} < (select max({c}) from tr))"
    found = f"(select unnest(quantile_disc({c}, [0.2, 0.4, 0.6, 0.8])) as q from tr), (select max({c}) as t from tr)"
    return f"select distinct cut from (select case when q < t then q else {below} end as cut from {found}) where cut is not null"


def _steps(c: str) -> str:
    """Number of distinct cuts below the value."""
    cuts = f"(select list(cut) from ({_cuts(c)}))"
    return f"case when {c} is not null then coalesce(len(list_filter({cuts}, lambda q: q < {c})), 0) end"


def _bins(source: str) -> dict[str, str]:
    long = [f"select '{c}' as feature, cast({_steps(c)} as varchar) as bin, target from tr" for c in NUMERIC]
    long += [f"select '{c}' as feature, {c} as bin, target from tr" for c in TEXT]
    return {
        "tr": source,
        "long": " union all ".join(long),
        "cells": """select feature, bin, t.target, count(*) filter (where long.target = t.target) as n
                    from long cross join (values (0), (1)) as t(target) group by 1, 2, 3""",
        "margins": """select *, sum(n) over (partition by feature, bin) as r, sum(n) over (partition by feature, target) as c,
                      sum(n) over (partition by feature) as total from cells""",
        "stat": """select feature, sum((n - r * c / total) ** 2 / (r * c / total)) as chi2, max(total) as total,
                   count(distinct coalesce(bin, '<null>')) as bins,
                   sum(case when n > 0 then n / total * ln(n * total / (r * c)) else 0 end) as mi
                   from margins group by 1""",
        "ranked": "select feature, round(chi2, 6) as chi2, round(sqrt(chi2 / total), 6) as cramer_v, "
        "round(mi, 6) as mutual_information from stat where bins > 1",
    }


def _bands(value: str, bands) -> str:
    *bounded, (_, last) = bands
    return "case " + " ".join(f"when {value} < {u} then '{label}'" for u, label in bounded) + f" else '{last}' end"


_TRAIN = "select * from split_dataset where ind_split = 'train'"
_STATS = _bins(_TRAIN)
_HALF = _bins(f"{_TRAIN} and {key_hash(2014)} < cast(0.5 as double) * 4294967296")
_MI = "select feature, mutual_information from"
_ORDER = "order by mutual_information desc, feature"
_CRAMER = f"select feature, cramer_v, {_bands('cramer_v', CRAMER_BANDS)} as strength from ranked"
_MUTUAL = f"select feature, mutual_information, {_bands('mutual_information', MUTUAL_BANDS)} as strength from ranked"


def _section(source: str, section: str, row: str, columns) -> str:
    return " union all ".join(
        f"select {section} as section, cast({row} as varchar) as row, '{c}' as \"column\", "
        f"cast({c} as double) as value from {source}" for c in columns
    )


_KS_VALUES = [c for c in evaluation.KS_COLUMNS if c != "decile"]


ORACLE = {
    "feature_importance_rf": importance_query("{c}"),
    "quantile_cuts": query(
        " union all ".join(
            f"""select '{c}' as feature, cast(generate_subscripts(cuts, 1) - 1 as integer) as i,
                cast(unnest(cuts) as double) as cut
                from (select list_sort(list(cut)) as cuts from ({_cuts(c)}))"""
            for c in NUMERIC
        ),
        "split_dataset",
        tr=_TRAIN,
    ),
    "quantile_buckets": query(
        "select ident, month, " + ", ".join(f"cast({_steps(c)} as integer) as {c}" for c in NUMERIC) + " from tr",
        "split_dataset",
        tr=_TRAIN,
    ),
    "chi_square": query("select feature, chi2 from ranked order by chi2 desc, feature limit 100", "split_dataset", **_STATS),
    "cramers_v": query(_CRAMER, "split_dataset", **_STATS),
    "cramers_v_resampled": query(_CRAMER, "split_dataset", **_HALF),
    "mutual_information": query(_MUTUAL, "split_dataset", **_STATS),
    "criterion_top": query(f"{_MI} ranked {_ORDER} limit 4", "split_dataset", **_STATS),
    "criterion_percentile": query(
        f"""{_MI} (select *, coalesce(sum(mutual_information) over ({_ORDER} rows between unbounded preceding
            and 1 preceding), 0) / sum(mutual_information) over () as share from ranked) where share < 0.8""",
        "split_dataset",
        **_STATS,
    ),
    "criterion_threshold": query(f"{_MI} ranked where mutual_information > 0.0005", "split_dataset", **_STATS),
    "criterion_perc": query(
        f"""{_MI} (select *, row_number() over ({_ORDER}) as i, count(*) over () as n from ranked)
            where i <= ceil(cast(0.3 as double) * n)""",
        "split_dataset",
        **_STATS,
    ),
    "chosen_features": query(
        """select cast(row_number() over (order by cramer_v desc, feature) - 1 as integer) as position, feature
           from ranked order by cramer_v desc, feature limit 5""",
        "split_dataset",
        **_STATS,
    ),
    "report_feature_selection": query(
        f"""select 'chisqrd' as method, feature, chi2 as statistic, cast(null as varchar) as strength from ranked
            union all select 'cramer', * from ({_CRAMER}) union all select 'mtinfo', * from ({_MUTUAL})""",
        "split_dataset",
        **_STATS,
    ),
    "report_performance": " union all ".join(
        [
            _section(f"({scoring.ORACLE['metrics_report']})", "'METRICS'", "metric_name", ("train", "test", "val")),
            _section(
                f"(select * from ({scoring.ORACLE['ks_table']}) where ind_split <> 'val')",
                "'KS_' || upper(ind_split)", "decile", _KS_VALUES,
            ),
            _section(
                f"({scoring.ORACLE['ks_by_month']})", "'KS_VAL' || strftime(month, '%Y%m')", "decile", _KS_VALUES
            ),
        ]
    ),
}
