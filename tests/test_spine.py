from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, month_window, run_stamp, stamp_text
from tidemark.operators import spine as ops
from tidemark.options import Options, SpineColumns
from tidemark.plans.split import fit_split
from tidemark.sources.lake import scan_window
from workloads.fixtures import OPTIONS, SPINE, spine_window, table


def test_splits_are_disjoint_and_complete(spark, sf_dir):
    rows = spine_window(spark, sf_dir)
    plan = fit_split(rows, replace(OPTIONS, min_prior=None))
    assigned = plan.assign(rows)
    assert assigned.count() == rows.count() == assigned.select("ident", "month").distinct().count()
    counts = {r["ind_split"]: r["count"] for r in assigned.groupBy("ind_split").count().collect()}
    assert counts.keys() == {"train", "test", "val"}
    assert 0.65 < counts["train"] / (counts["train"] + counts["test"]) < 0.75
    assert plan.fractions is None and plan.transform(rows).count() == rows.count()


def test_sampling_reaches_the_prior_and_leaves_other_splits(spark, sf_dir):
    rows = spine_window(spark, "/root/testdata/sf0.01")
    plan = fit_split(rows, OPTIONS)
    before, after = plan.assign(rows), plan.transform(rows)
    rates = after.groupBy("ind_split").agg(F.avg("target").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    found = {r["ind_split"]: r for r in rates}
    assert found["train"]["p"] == pytest.approx(0.35, abs=0.02)
    for split in ("test", "val"):
        assert before.where(F.col("ind_split") == split).count() == found[split]["n"]


def test_single_class_periods_are_kept_whole(spark):
    rows = spark.createDataFrame(
        [(i, date(2020, 1 + i % 2, 1), 1 if i % 2 else 0) for i in range(200)], "ident long, month date, target int"
    )
    options = Options(spine=SPINE, n_months_val=0, train_size=1.0, min_prior=0.5)
    assert fit_split(rows, options).transform(rows).count() == 200


def test_null_targets_stay(spark):
    rows = spark.createDataFrame(
        [(i, date(2020, 1, 1), None if i % 4 == 0 else int(i % 10 == 1)) for i in range(400)],
        "ident long, month date, target int",
    )
    options = Options(spine=SPINE, n_months_val=0, train_size=1.0, min_prior=0.5)
    found = fit_split(rows, options).transform(rows)
    assert found.where("target is null").count() == 100
    assert found.count() < 400


def test_sampling_does_not_depend_on_partitions(spark, sf_dir):
    rows = spine_window(spark, sf_dir)
    found = [
        fit_split(rows.repartition(n), OPTIONS).transform(rows.repartition(n)).agg(F.bit_xor(F.xxhash64("ident", "month")), F.count(F.lit(1))).first()
        for n in (1, 17)
    ]
    assert found[0] == found[1]


def test_text_dates_split_like_dates(spark, sf_dir):
    """Periods held as yyyy-MM-dd text, identifiers as text."""
    rows = spine_window(spark, sf_dir)
    text = rows.select(F.col("ident").cast("string").alias("ident"), F.col("month").cast("string").alias("month"), "target")
    options = replace(OPTIONS, prior_map={"1999-12-01": 0.6})
    wanted = fit_split(rows, options).transform(rows).select(text.columns + ["ind_split"])
    found = fit_split(text, options).transform(text)
    shaped = wanted.select(F.col("ident").cast("string"), F.col("month").cast("string"), "target", "ind_split")
    assert found.exceptAll(shaped).isEmpty() and found.count() == wanted.count()


def test_id_for_text_identifiers(spark):
    rows = spark.createDataFrame([("b", date(2020, 1, 1)), ("a", date(2020, 2, 1)), ("a", date(2020, 1, 1))], "ident string, month date")
    found = {(r["ident"], r["month"].month): r["id"] for r in ops.with_id(rows, SPINE).collect()}
    assert found == {("a", 1): 1, ("b", 1): 2, ("a", 2): 3}


def test_distinct_periods_come_in_order(spark, sf_dir):
    months = [r["month"] for r in ops.distinct_periods(spine_window(spark, sf_dir), "month").collect()]
    assert months == sorted(months)


def test_month_window():
    assert month_window("2020-01-31", "%Y-%m-%d", months=1) == (date(2020, 1, 31), date(2020, 2, 29))
    assert month_window("2020-02-15", "%Y-%m-%d", first_offset=-3) == (date(2019, 11, 1), date(2019, 11, 30))


def test_stamps(spark):
    text = stamp_text()
    assert len(text) == 15 and text[8] == "_"
    row = spark.range(1).select(run_stamp(F.lit("2020-03-04 05:06:07").cast("timestamp")).alias("s"), as_date(F.lit("x"), "yyyy").alias("d"))
    assert row.first() == ("20200304_050607", None)


def test_window_filter_reaches_the_scan(spark, sf_dir):
    found = scan_window(table(spark, sf_dir, "orders"), "o_orderdate", date(1996, 1, 1), date(1996, 12, 31))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    text = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    assert scan_window(text, "d", date(1996, 1, 1), date(1996, 12, 31)).count() == found.count()


def test_window_prunes_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "spine")
    spine_window(spark, sf_dir).write.partitionBy("month").parquet(path)
    found = scan_window(spark.read.parquet(path), "month", date(1996, 1, 1), date(1996, 12, 31))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert len(found.inputFiles()) > 0 and found.select("month").distinct().count() == 12


def test_options_from_config():
    config = {
        "mode": "PROD", "feat_drop": ["x"],
        "conf": {"train_size": 0.6, "spine": {"target_col": "t", "artf_id_col": "i", "ident_col": "c", "date_col": "d", "ind_split_col": "s"},
                 "eval": {"error": 0.1, "buckets": 5}, "shuffle": False, "bin_input": ["b"]},
    }
    options = Options.from_config(config)
    assert options.spine == SpineColumns("t", "i", "c", "d", "s")
    assert (options.train_size, options.eval_error, options.eval_buckets) == (0.6, 0.1, 5)
    assert options.feat_drop == ("x",) and options.bin_input == ("b",) and options.mode == "PROD"
    with pytest.raises(ValueError):
        Options(train_size=2)
