"""Scores, buckets, metrics, KS tables and audits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import audit, evaluation, merge, scoring
from tidemark.sources.lake import latest_slice
from tidemark.sources.staging import stage
from workloads.fixtures import KEYS, NUMERIC, TEXT, dataset, rounded, score_history, scored_cm, spine_window, with_deciles
from workloads.sql import query

TIES = ["month", "ident"]


def score_proba(spark, sf_dir):
    return scoring.score_proba(scored_cm(spark, sf_dir), is_vector=False).select(*KEYS, "score")


def score_logit(spark, sf_dir):
    return rounded(scoring.score_logit(scored_cm(spark, sf_dir), is_vector=False).select(*KEYS, "score_alt"))


def deciles(spark, sf_dir):
    return with_deciles(spark, sf_dir).select(*KEYS, "ind_split", "p", "deciles")


def deciles_overall(spark, sf_dir):
    """Buckets over the whole frame, as production scoring makes them."""
    return scoring.score_buckets(scored_cm(spark, sf_dir), "p", TIES).select(*KEYS, "p", "deciles")


def deciles_approx(spark, sf_dir):
    """Buckets from approximate cuts: every row in one, no score in two, higher scores first."""
    rows = scoring.score_buckets(scored_cm(spark, sf_dir), "p", TIES, ["ind_split"], error=0.001)
    per_score = rows.groupBy("ind_split", "p").agg(
        F.count(F.lit(1)).alias("n"), F.min("deciles").alias("low"), F.max("deciles").alias("high")
    )
    after = F.lag("high").over(Window.partitionBy("ind_split").orderBy(F.desc("p")))
    ordered = (F.col("low") == F.col("high")) & (F.coalesce(after, F.lit(1)) <= F.col("low"))
    return per_score.withColumn("ordered", ordered).groupBy("ind_split").agg(
        F.sum("n").alias("n"), F.bool_and("ordered").alias("ordered")
    )


def metrics_class(spark, sf_dir):
    return rounded(evaluation.class_metrics(scored_cm(spark, sf_dir), "target", groups=["ind_split"]))


def metrics_auc(spark, sf_dir):
    return rounded(evaluation.area_metrics(scored_cm(spark, sf_dir), "target", "p", ["ind_split"]))


def metrics_report(spark, sf_dir):
    return rounded(evaluation.metrics_report(scored_cm(spark, sf_dir), "target", "p", split="ind_split"))


def ks_table(spark, sf_dir):
    return rounded(evaluation.ks_table(with_deciles(spark, sf_dir), "target", "p", groups=["ind_split"]))


def ks_by_month(spark, sf_dir):
    rows = scored_cm(spark, sf_dir).where("ind_split = 'val'")
    return rounded(evaluation.ks_by_period(rows, "target", "p", ["ident"], "month"))


def eval_production(spark, sf_dir):
    """Metrics of the last production slice against known outcomes."""
    known = merge.join_outcomes(
        latest_slice(score_history(spark, sf_dir), "month"), spine_window(spark, sf_dir), KEYS
    )
    return rounded(evaluation.metrics_report(known, "target", "p"))


def eval_production_ks(spark, sf_dir):
    last = latest_slice(score_history(spark, sf_dir), "month")
    known = merge.join_outcomes(scoring.score_buckets(last, "p", TIES), spine_window(spark, sf_dir), KEYS)
    return rounded(evaluation.ks_table(known, "target", "p"))


def audit_numeric(spark, sf_dir):
    rows = stage(dataset(spark, sf_dir).select("month", *NUMERIC, "mostly_null"))
    found = audit.audit_numeric(rows, "month", [*NUMERIC, "mostly_null"])
    # Interpolated values have at most 8 decimals, so rounding there meets no
    # ties; means of few values do end in a 5, so they are moved off the tie.
    return found.withColumns(
        {c: F.round(c, 8) for c in ("min", "p25", "p50", "p75", "max")}
        | {c: F.round(F.col(c) + 1e-7, 4) for c in ("pct_null", "mean", "std")}
    )


def audit_categorical(spark, sf_dir):
    return rounded(audit.audit_categorical(dataset(spark, sf_dir), "month", TEXT))


QUERIES = {
    "score_proba": score_proba,
    "score_logit": score_logit,
    "deciles": deciles,
    "deciles_overall": deciles_overall,
    "deciles_approx": deciles_approx,
    "metrics_class": metrics_class,
    "metrics_auc": metrics_auc,
    "metrics_report": metrics_report,
    "ks_table": ks_table,
    "ks_by_month": ks_by_month,
    "eval_production": eval_production,
    "eval_production_ks": eval_production_ks,
    "audit_numeric": audit_numeric,
    "audit_categorical": audit_categorical,
}

_CLASS = """
    select {keys} (tp + tn) / n as accuracy,
      ((tp + fn) * pp + (tn + fp) * pn) / n as weightedPrecision, ((tp + fn) * rp + (tn + fp) * rn) / n as weightedRecall,
      ((tp + fn) * coalesce(2 * pp * rp / nullif(pp + rp, 0), 0)
       + (tn + fp) * coalesce(2 * pn * rn / nullif(pn + rn, 0), 0)) / n as f1
    from (select *, coalesce(tp / nullif(tp + fp, 0), 0) as pp, coalesce(tn / nullif(tn + fn, 0), 0) as pn,
                 coalesce(tp / nullif(tp + fn, 0), 0) as rp, coalesce(tn / nullif(tn + fp, 0), 0) as rn
          from (select {keys} count(*) as n, count(*) filter (where target = 1 and prediction = 1) as tp,
                  count(*) filter (where target = 0 and prediction = 1) as fp,
                  count(*) filter (where target = 0 and prediction = 0) as tn,
                  count(*) filter (where target = 1 and prediction = 0) as fn
                from {source} {group}))"""
_AREA = """
    select {keys} sum(n * (2 * tp - p1) / 2) / nullif(max(pos) * max(neg), 0) as areaUnderROC,
           sum(p1 * (tp / (tp + fp) + coalesce((tp - p1) / nullif(tp - p1 + fp - n, 0), tp / (tp + fp))) / 2)
             / case when max(neg) > 0 then nullif(max(pos), 0) end as areaUnderPR
    from (select *, sum(p1) over w as tp, sum(n) over w as fp, sum(p1) over ({over}) as pos, sum(n) over ({over}) as neg
          from (select {keys} p, count(*) filter (where target = 1) as p1, count(*) filter (where target = 0) as n
                from {source} group by {keys} p)
          window w as ({over} order by p desc)) {group}"""
_NAMES = ("accuracy", "weightedPrecision", "weightedRecall", "f1", "areaUnderROC", "areaUnderPR")
_BY_SPLIT = {"keys": "ind_split,", "group": "group by ind_split", "over": "partition by ind_split"}
_WHOLE = {"keys": "", "group": "", "over": "partition by 1"}


def _rounded(names, places=6) -> str:
    return ", ".join(f"round({n}, {places}) as {n}" for n in names)


def _ks(source: str, groups: str = "", bucket: str = "deciles") -> str:
    keys = f"{groups}," if groups else ""
    part = f"partition by {groups}" if groups else "partition by 1"
    shares = ("min_score", "max_score", "avg_score", "event_rate", "cum_event_rate", "pct_pos", "pct_neg",
              "cum_pct_pos", "cum_pct_neg", "lift", "ks")
    return f"""
    select {keys} decile, n, positives, negatives, {_rounded(shares)}
    from (select *, event_rate / nullif(sum(positives) over g / sum(n) over g, 0) as lift, abs(cum_pct_pos - cum_pct_neg) as ks
          from (select *, positives / n as event_rate, sum(positives) over c / sum(n) over c as cum_event_rate,
                       positives / nullif(sum(positives) over g, 0) as pct_pos,
                       negatives / nullif(sum(negatives) over g, 0) as pct_neg,
                       sum(positives) over c / nullif(sum(positives) over g, 0) as cum_pct_pos,
                       sum(negatives) over c / nullif(sum(negatives) over g, 0) as cum_pct_neg
                from (select {keys} {bucket} as decile, count(*) as n, min(p) as min_score, max(p) as max_score,
                             avg(p) as avg_score, count(*) filter (where target = 1) as positives,
                             count(*) filter (where target = 0) as negatives
                      from {source} group by {keys} {bucket})
                window g as ({part}), c as ({part} order by decile))
          window g as ({part}))"""


def _metric_rows(columns: str) -> str:
    return " union all ".join(columns.format(name=n) for n in _NAMES)


_LAST = """select * from history where month = (select max(month) from history)
           and exec_time = (select max(exec_time) from history)"""
_LONG_NUMERIC = " union all ".join(
    f"select month, '{c}' as variable, cast({c} as double) as value from dataset" for c in [*NUMERIC, "mostly_null"]
)
_LONG_TEXT = " union all ".join(f"select month, '{c}' as variable, {c} as value from dataset" for c in TEXT)

ORACLE = {
    "score_proba": query("select ident, month, p as score from scored", "scored"),
    "score_logit": query(
        """select ident, month, round(ln(c / (1 - c)), 6) as score_alt from
           (select *, greatest(least(p, cast(1 - 1e-6 as double)), cast(1e-6 as double)) as c from scored)""",
        "scored",
    ),
    "deciles": query("select ident, month, ind_split, p, deciles from with_deciles", "with_deciles"),
    "deciles_overall": query(
        "select ident, month, p, cast(ntile(10) over (order by p desc, month, ident) as integer) as deciles from scored",
        "scored",
    ),
    "deciles_approx": query("select ind_split, count(*) as n, true as ordered from scored group by 1", "scored"),
    "metrics_class": query(
        f"select ind_split, {_rounded(_NAMES[:4])} from ({_CLASS.format(source='scored', **_BY_SPLIT)})", "scored"
    ),
    "metrics_auc": query(
        f"select ind_split, {_rounded(_NAMES[4:])} from ({_AREA.format(source='scored', **_BY_SPLIT)})", "scored"
    ),
    "metrics_report": query(
        _metric_rows(
            "select '{name}' as metric_name, " + ", ".join(
                f"(select round({{name}}, 6) from wide where ind_split = '{s}') as {s}" for s in ("train", "test", "val")
            )
        ),
        "scored",
        wide=f"select * from ({_CLASS.format(source='scored', **_BY_SPLIT)}) "
        f"join ({_AREA.format(source='scored', **_BY_SPLIT)}) using (ind_split)",
    ),
    "ks_table": query(_ks("with_deciles", "ind_split"), "with_deciles"),
    "ks_by_month": query(
        _ks("monthly", "month"),
        "scored",
        monthly="""select *, cast(ntile(10) over (partition by month order by p desc, ident) as integer) as deciles
                   from scored where ind_split = 'val'""",
    ),
    "eval_production": query(
        _metric_rows("select '{name}' as metric_name, round({name}, 6) as value from wide"),
        "history",
        known=f"select * from ({_LAST}) join spine using (ident, month)",
        wide=f"select * from ({_CLASS.format(source='known', **_WHOLE)}), ({_AREA.format(source='known', **_WHOLE)})",
    ),
    "eval_production_ks": query(
        _ks("known"),
        "history",
        known=f"""select * from (select *, cast(ntile(10) over (order by p desc, month, ident) as integer) as deciles
                  from ({_LAST})) join spine using (ident, month)""",
    ),
    "audit_numeric": query(
        """select month, variable, count(*) as n, count(*) - count(value) as n_null,
             round(avg(case when value is null then 1.0 else 0.0 end) + 1e-7, 4) as pct_null,
             count(*) filter (where value = 0) as n_zero, round(avg(value) + 1e-7, 4) as mean,
             round(stddev_samp(value) + 1e-7, 4) as std, round(min(value), 8) as min,
             round(quantile_cont(value, 0.25), 8) as p25, round(quantile_cont(value, 0.5), 8) as p50,
             round(quantile_cont(value, 0.75), 8) as p75, round(max(value), 8) as max
           from long group by 1, 2""",
        "dataset",
        long=_LONG_NUMERIC,
    ),
    "audit_categorical": query(
        """select month, variable, value, n, round(n / sum(n) over (partition by month, variable), 6) as pct
           from (select month, variable, value, count(*) as n from long group by 1, 2, 3)""",
        "dataset",
        long=_LONG_TEXT,
    ),
}
