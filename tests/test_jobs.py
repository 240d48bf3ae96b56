"""All monthly jobs in order, on tables made from the driver's files."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark import Options, jobs
from tidemark.operators import merge
from tidemark.plans.encode import EncodePlan
from tidemark.plans.production import ProductionPlan
from tidemark.plans.split import fit_split
from tidemark.sources import lake
from workloads.fixtures import KEYS, dirty, feat_lineitem, feat_orders, spine_cm


@pytest.fixture(scope="module")
def setup(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("jobs"))
    spark.sql(f"CREATE DATABASE lakes LOCATION '{folder}/lake'")
    spine = spine_cm(spark, sf_dir)
    candidates = spine.select(
        F.col("ident").alias("cliident"), F.date_format("month", "yyyy-MM-dd").alias("date_part"),
        F.col("target").cast("string").alias("target"),
    )
    candidates.write.saveAsTable("lakes.potentials")

    def source(df, name):
        df.withColumnsRenamed({"ident": "raw_ident", "month": "raw_month"}).write.saveAsTable(f"lakes.{name}")

    source(feat_orders(spark, sf_dir), "orders_src")
    source(feat_lineitem(spark, sf_dir).join(spine.select(*KEYS), KEYS, "right").join(
        dirty(spark, sf_dir).drop("c_acctbal"), "ident", "left"), "lines_src")
    config = {
        "schema": "lakes",
        "folder": f"{folder}/out",
        "mode": "DEV",
        "new_part_cols": ["data_date_part"],
        "feat_drop": ["constant_txt"],
        "ini_date": ["2000-01-01", "%Y-%m-%d"],
        "qty_months": 18,
        "source_keys": ["raw_ident", "raw_month"],
        "table_sources": {
            "spine": "lakes.potentials", "spine_prod": "lakes.potentials",
            "clean_0": "lakes.orders_src", "clean_1": "lakes.lines_src",
        },
        "table_outputs": {
            "spine": "p_spine", "clean_0": "p_cleaned_0", "clean_1": "p_cleaned_1", "dataset": "p_dataset",
            "pred": "p_pred_a", "score": "p_score_a", "prod": "p_score_prod",
        },
        "conf": {"n_months_val": 3, "min_prior": 0.3, "feat_mode": "cramer", "criterion": "top", "top": 12},
    }
    path = tmp_path_factory.mktemp("config") / "config.json"
    path.write_text(json.dumps(config))
    return jobs.Setup.from_config(json.loads(path.read_text()))


def test_jobs_in_order(spark, setup):
    spine = spark.read.table(jobs.build_spine(spark, setup))
    assert set(spine.columns) == set(setup.options.spine.all())
    ids = spine.select("id").distinct().count()
    assert ids == spine.count()
    for i in (0, 1):
        cleaned = spark.read.table(jobs.clean_source(spark, setup, i))
        assert cleaned.count() == spine.count()
    data = spark.read.table(jobs.merge_sources(spark, setup))
    assert data.count() == spine.count() and "total_price" in data.columns and "segment_HOUSEHOLD" in data.columns
    at_once = jobs.select_associations(spark, setup)
    alone = jobs.select_features(spark, setup, "cramer")
    rows = {r["feature"]: r["cramer_v"] for r in at_once["cramer"].collect()}
    assert {r["feature"]: r["cramer_v"] for r in alone.collect()} == pytest.approx(rows)
    jobs.select_features(spark, setup, "infogain")
    jobs.train(spark, setup, maxIter=2)
    chosen = lake.read_features(spark, setup.path("feat_sel", "chosen"))
    assert 0 < len(chosen) <= 12
    scores = spark.read.table(jobs.score(spark, setup))
    assert scores.count() == spine.count()
    with pytest.raises(LookupError):
        lake.latest_version(spark, "lakes", "p_pred_a")
    jobs.assess(spark, setup)
    features, performance = jobs.merge_reports(spark, setup)
    assert {r["method"] for r in features.select("method").distinct().collect()} == {"infogain", "chisqrd", "cramer", "mtinfo"}
    sections = {r["section"] for r in performance.select("section").distinct().collect()}
    assert {"METRICS", "FEAT_IMPORT_MODEL", "KS_TRAIN", "KS_TEST", "KS_VAL200107"} <= sections
    jobs.audit_split(spark, setup, "test")
    jobs.refit(spark, setup)
    name = jobs.produce(spark, setup, "2001-09-15")
    assert {str(r[0]) for r in spark.read.table(name).select("data_date_part").distinct().collect()} == {"2001-06-01"}
    first = spark.read.table(name).count()
    jobs.produce(spark, setup, "2001-09-15")
    assert spark.read.table(name).count() == first
    jobs.produce(spark, setup, "2001-10-15")
    history = spark.read.table(name)
    assert history.select("data_date_part").distinct().count() == 2
    outcomes = spine.select("cliident", "data_date_part", "target")
    outcomes.write.saveAsTable("lakes.outcomes")
    jobs.evaluate(spark, setup, "lakes.outcomes")
    metrics = lake.read_report(spark, setup.path("prod", "metrics"), "metric_name string, value double")
    assert metrics.count() == 6
    before = lake.load_fitted(PipelineModel, setup.own("model")).uid
    other = replace(
        setup, alias="b", tables=setup.tables | {"pred": "p_pred_b"},
        options=replace(setup.options, feat_mode="mtinfo", top=60))
    jobs.train(spark, other, maxIter=1)
    assert lake.load_fitted(PipelineModel, other.own("model")).uid != before
    assert lake.load_fitted(PipelineModel, setup.own("model")).uid == before
    jobs.refit(spark, other)
    plan = ProductionPlan.load(spark, other.own("production"))
    wanted = plan.model.stages[0].getInputCols()
    known = plan.encode.dummy_sources()
    lost = next(c for c in wanted if c in known)
    fewer = {c: tuple(v for v in labels if f"{c}_{v}" != lost) for c, labels in plan.encode.labels.items()}
    raw = merge.merge_windowed(
        setup.read(spark, "spine").select("cliident", "data_date_part"), setup.raw_sources(spark),
        ("cliident", "data_date_part"), *setup.bounds(), keep=plan.clean.columns,
    )
    made = replace(plan, encode=EncodePlan(fewer)).features(raw)
    assert set(wanted) <= set(made.columns) and made.where(F.col(f"`{lost}`") != 0).isEmpty()
    wide_text_columns(spark, setup)


def wide_text_columns(spark, setup):
    """Columns of more labels than ``max_labels`` go from cleaning to production as text."""
    wide = replace(
        setup, alias="w", folder=setup.folder + "/wide", stamp="20990101_000000",
        options=replace(setup.options, max_labels=4, feat_mode="mtinfo", top=60),
        tables=setup.tables | {k: f"w_{v}" for k, v in setup.tables.items() if k != "spine"})
    for i in (0, 1):
        jobs.clean_source(spark, wide, i)
    data = spark.read.table(jobs.merge_sources(spark, wide))
    assert {"segment", "nation_name", "top_status_F"} <= set(data.columns) and "segment_HOUSEHOLD" not in data.columns
    gains = {r["feature"] for r in jobs.select_features(spark, wide, "infogain").collect()}
    ranked = {r["feature"] for r in jobs.select_associations(spark, wide, ("mtinfo",))["mtinfo"].collect()}
    assert {"segment", "nation_name", "total_price"} <= gains & ranked
    jobs.train(spark, wide, maxIter=1)
    jobs.score(spark, wide)
    jobs.assess(spark, wide)
    known = lake.read_report(spark, wide.own("feat_import"), "feature string, importance double")
    assert known.where("feature like 'segment\\_%'").count() == 5
    jobs.refit(spark, wide)
    plan = ProductionPlan.load(spark, wide.own("production"))
    assert set(plan.labels.sizes) >= {"segment", "nation_name"} and "segment" not in plan.encode.labels
    scored = spark.read.table(jobs.produce(spark, wide, "2001-09-15"))
    assert scored.where("score is null").isEmpty() and scored.count() > 0


def test_sources_by_name_and_repeated_keys(spark, setup):
    many = replace(setup, sources=setup.sources | {f"clean_{i}": setup.sources["clean_0"] for i in range(2, 11)})
    many.sources["clean_10"] = setup.sources["clean_1"]
    assert "returnflag" in many.raw_source(spark, "clean_10").table.columns
    assert "returnflag" not in many.raw_source(spark, "clean_2").table.columns
    assert "returnflag" in many.raw_sources(spark)[10].table.columns
    source = setup.raw_source(spark, "clean_0")
    twice = replace(source, table=source.table.union(source.table))
    people = source.table.select(F.col("raw_ident").alias("cliident"), F.col("raw_month").alias("data_date_part"))
    with pytest.raises(SparkRuntimeException, match="repeats"):
        merge.merge_windowed(people, [twice], ("cliident", "data_date_part"), *setup.bounds()).count()


def test_columns_unknown_to_the_table_are_refused(spark, sf_dir):
    rows = spine_cm(spark, sf_dir)
    lake.append_or_create(rows, "lakes.history_b")
    with pytest.raises(ValueError, match="lacks"):
        lake.append_or_create(rows.withColumn("more", F.lit(1)), "lakes.history_b")


def test_priors_out_of_reach_are_refused(spark):
    with pytest.raises(ValueError, match="priors"):
        Options(min_prior=0.995)
    days = spark.createDataFrame([(i, "2020-01-01", int(i < 80)) for i in range(100)], "cliident long, d string, target int")
    rows = days.select("cliident", F.col("d").cast("date").alias("data_date_part"), "target")
    with pytest.raises(Exception, match="factor_mult"):
        fit_split(rows, Options(factor_mult=2.0, n_months_val=0, train_size=1.0))


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    rows = spine_cm(spark, sf_dir)
    left = lake.save_versioned(rows, "lakes", "b_left", "20240101_000000", bucket_by=(4, KEYS))
    right = lake.save_versioned(rows.withColumnRenamed("target", "t"), "lakes", "b_right", "20240101_000000", bucket_by=(4, KEYS))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.read.table(left).join(spark.read.table(right), KEYS, "left")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_missing_report_is_none_and_other_errors_raise(spark, tmp_path):
    assert lake.read_if_present(spark, str(tmp_path / "none"), "a string") is None
    with pytest.raises(Exception):
        lake.read_if_present(spark, str(tmp_path), "a strange type")
    with pytest.raises(LookupError):
        lake.latest_version(spark, "lakes", "nothing")
