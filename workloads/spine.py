"""Scans, dates, splits and priors."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, month_end, month_label, month_start, run_stamp
from tidemark.operators import spine as ops
from tidemark.plans.split import fit_split
from tidemark.sources.lake import latest_slice, scan_window
from tidemark.sources.staging import stage
from workloads.fixtures import (
    END,
    OPTIONS,
    SPINE,
    START,
    months,
    rounded,
    score_history,
    spine_cm,
    spine_day,
    spine_window,
    table,
)
from workloads.sql import key_hash, query, split_case


def scan_date_window(spark, sf_dir):
    return scan_window(table(spark, sf_dir, "orders"), "o_orderdate", START, END).select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day")
    )


def cast_target(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.substring("o_orderpriority", 1, 1))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("target"))
    return ops.cast_target(rows)


def month_bounds(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    text = as_date(F.date_format("day", "dd/MM/yyyy"), "dd/MM/yyyy")
    return days.select(
        "day",
        month_start(text, -3).alias("first_day"),
        month_end(text).alias("last_day"),
        month_end(text, 2).alias("last_day_ahead"),
    )


def month_labels(spark, sf_dir):
    return spine_cm(spark, sf_dir).groupBy(month_label("month").alias("label")).agg(F.count(F.lit(1)).alias("n"))


def distinct_months(spark, sf_dir):
    return ops.distinct_periods(spine_cm(spark, sf_dir), "month")


def spine_id(spark, sf_dir):
    return ops.with_id(spine_cm(spark, sf_dir), SPINE)


def split_val(spark, sf_dir):
    rows = spine_window(spark, sf_dir)
    split = fit_split(months(spark, sf_dir), replace(OPTIONS, min_prior=None, n_months_val=2)).split()
    return rows.select("ident", "month", (split == "val").alias("is_val"))


def split_train_test(spark, sf_dir):
    rows = spine_window(spark, sf_dir)
    return fit_split(months(spark, sf_dir), replace(OPTIONS, min_prior=None)).assign(rows)


def prior_sampling(spark, sf_dir):
    rows = stage(spine_window(spark, sf_dir))
    return fit_split(rows, OPTIONS).transform(rows)


def prior_map_sampling(spark, sf_dir):
    rows = stage(spine_window(spark, sf_dir))
    wanted = replace(OPTIONS, min_prior=0.02, factor_mult=0.5, prior_map={"1996-05-01": 0.6, "1999-12-01": 0.9})
    return fit_split(rows, wanted).transform(rows)


def prior_report(spark, sf_dir):
    rows = stage(spine_window(spark, sf_dir))
    plan = fit_split(rows, OPTIONS)
    train = ops.split_rows(plan.assign(rows), SPINE, "train")
    return rounded(ops.prior_report(train, plan.sample(train), SPINE))


def daily_sampling(spark, sf_dir):
    """Days as periods: the last five validate, train is thinned to a rate of a half."""
    rows = stage(spine_day(spark, sf_dir))
    return fit_split(rows, replace(OPTIONS, n_months_val=5, min_prior=0.5)).transform(rows)


def ind_split(spark, sf_dir):
    """Id, split and sampled train rows: the whole spine as it is saved."""
    rows = ops.with_id(ops.cast_target(spine_window(spark, sf_dir)), SPINE)
    return fit_split(rows, OPTIONS).transform(rows).select(*SPINE.all())


def scan_split(spark, sf_dir):
    return ops.split_rows(split_train_test(spark, sf_dir), SPINE, "test")


def resample_rows(spark, sf_dir):
    return ops.resample(spine_cm(spark, sf_dir), 0.5, SPINE)


def repartition(spark, sf_dir):
    """Rows before a wide write, by a fixed count."""
    return ops.redistribute(spine_cm(spark, sf_dir), 16, "ident")


def rebalance(spark, sf_dir):
    """Rows before a wide write, sized and split by adaptive execution."""
    return ops.redistribute(spine_cm(spark, sf_dir), None, "month")


def union_splits(spark, sf_dir):
    rows = split_train_test(spark, sf_dir)
    return ops.union_splits(*[ops.split_rows(rows, SPINE, name) for name in ("train", "test", "val")])


def latest(spark, sf_dir):
    return latest_slice(score_history(spark, sf_dir), "month")


def latest_late(spark, sf_dir):
    return latest_slice(score_history(spark, sf_dir, late=True), "month", per_date=True)


def run_stamps(spark, sf_dir):
    """Events per run stamp, the suffix of table versions."""
    return table(spark, sf_dir, "events").groupBy(run_stamp(F.col("ts")).alias("stamp")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "run_stamps": run_stamps,
    "scan_date_window": scan_date_window,
    "scan_split": scan_split,
    "latest_slice": latest,
    "latest_slice_per_date": latest_late,
    "cast_target": cast_target,
    "distinct_months": distinct_months,
    "month_bounds": month_bounds,
    "month_label": month_labels,
    "spine_id": spine_id,
    "split_val": split_val,
    "split_train_test": split_train_test,
    "prior_sampling": prior_sampling,
    "prior_map_sampling": prior_map_sampling,
    "prior_report": prior_report,
    "daily_sampling": daily_sampling,
    "ind_split": ind_split,
    "union_splits": union_splits,
    "resample_rows": resample_rows,
    "repartition": repartition,
    "rebalance": rebalance,
}


def _sampled(source: str, prior: str) -> dict[str, str]:
    """CTEs ``fractions`` and ``sampled`` over ``source``; ``prior`` gives q from p and month."""
    return {
        "counts": f"""select month, count(*) filter (where target = 1) as n1, count(*) filter (where target = 0) as n0
                      from {source} where ind_split = 'train' group by 1""",
        "wanted": f"select *, {prior} as q from (select *, n1 / (n0 + n1) as p from counts)",
        "fractions": """select month,
                          case when n1 > 0 and n0 > 0 and q < p then n0 * q / ((1 - q) * n1) else 1.0 end as keep_pos,
                          case when n1 > 0 and n0 > 0 and q > p then n1 * (1 - q) / (q * n0) else 1.0 end as keep_neg
                        from wanted""",
        "sampled": f"""select s.* from {source} s left join fractions using (month)
                       where ind_split <> 'train' or {key_hash(2013)} <
                             cast(case target when 1 then keep_pos else keep_neg end as double) * 4294967296""",
    }


_FLOOR = "greatest(p, cast(0.35 as double))"
_MAPPED = """greatest(coalesce(case month when date '1996-05-01' then cast(0.6 as double)
             when date '1999-12-01' then cast(0.9 as double) end, p) * cast(0.5 as double), cast(0.02 as double))"""
_WITH_ID = {
    "with_id": "select *, row_number() over (order by month, ident) as id from spine",
    "split_id": f"select *, {split_case(1)} as ind_split from with_id",
}

ORACLE = {
    "run_stamps": "select strftime(ts, '%Y%m%d_%H%M%S') as stamp, count(*) as n from events group by 1",
    "scan_date_window": """
        select o_orderkey, o_custkey, cast(o_orderdate as date) as day from orders
        where o_orderdate >= date '1995-01-01' and o_orderdate < date '2001-08-01'""",
    "scan_split": query("select * from spine_split where ind_split = 'test'", "spine_split"),
    "latest_slice": query(
        """select * from history where month = (select max(month) from history)
           and exec_time = (select max(exec_time) from history)""",
        "history",
    ),
    "latest_slice_per_date": query(
        """select * from late_history where month = (select max(month) from late_history) and exec_time =
           (select max(exec_time) from late_history where month = (select max(month) from late_history))""",
        "late_history",
    ),
    "cast_target": """
        select o_orderkey, try_cast(case when o_orderkey % 7 = 0 then 'n/a'
               else substr(o_orderpriority, 1, 1) end as integer) as target from orders""",
    "distinct_months": query("select distinct month from spine_cm order by month", "spine_cm"),
    "month_bounds": """
        select day, cast(date_trunc('month', day - interval 3 month) as date) as first_day,
               last_day(day) as last_day, last_day(cast(day + interval 2 month as date)) as last_day_ahead
        from (select distinct cast(o_orderdate as date) as day from orders)""",
    "month_label": query("select strftime(month, '%Y%m') as label, count(*) as n from spine_cm group by 1", "spine_cm"),
    "spine_id": query("select *, row_number() over (order by month, ident) as id from spine_cm", "spine_cm"),
    "split_val": query(f"select ident, month, ({split_case(2)}) = 'val' as is_val from spine", "spine"),
    "split_train_test": query("select * from spine_split", "spine_split"),
    "prior_sampling": query("select * from sampled", "spine_split", **_sampled("spine_split", _FLOOR)),
    "prior_map_sampling": query("select * from sampled", "spine_split", **_sampled("spine_split", _MAPPED)),
    "prior_report": query(
        """select * from (select month, count(*) as n_orig, cast(sum(target) as bigint) as pos_orig,
                  round(avg(target), 6) as prior_orig from spine_split where ind_split = 'train' group by 1)
           left join (select month, count(*) as n_sampled, cast(sum(target) as bigint) as pos_sampled,
                  round(avg(target), 6) as prior_sampled from sampled where ind_split = 'train' group by 1) using (month)""",
        "spine_split",
        **_sampled("spine_split", _FLOOR),
    ),
    "daily_sampling": query(
        "select * from sampled",
        spine="""select user_id as ident, cast(ts as date) as month,
                 cast(max(case when event_type = 'purchase' then 1 else 0 end) as integer) as target
                 from events group by 1, 2""",
        day_split=f"select *, {split_case(5)} as ind_split from spine",
        **_sampled("day_split", "greatest(p, cast(0.5 as double))"),
    ),
    "ind_split": query("select * from sampled", "spine", **_WITH_ID, **_sampled("split_id", _FLOOR)),
    "union_splits": query("select * from spine_split", "spine_split"),
    "repartition": query("select * from spine_cm", "spine_cm"),
    "rebalance": query("select * from spine_cm", "spine_cm"),
    "resample_rows": query(
        f"select * from spine_cm where {key_hash(2014)} < cast(0.5 as double) * 4294967296", "spine_cm"
    ),
}
