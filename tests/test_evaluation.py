from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tidemark.operators import evaluation, scoring, selection
from tidemark.sources.lake import latest_slice
from workloads.fixtures import NUMERIC, TEXT, score_history, scored_cm, split_dataset, with_deciles


@pytest.fixture(scope="module")
def scored(spark):
    return scored_cm(spark, "/root/testdata/sf0.01").cache()


def test_areas_equal_the_evaluator(scored):
    found = evaluation.area_metrics(scored, "target", "p").first()
    for metric in evaluation.AREA_METRICS:
        judge = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="target", metricName=metric, numBins=0)
        assert found[metric] == pytest.approx(judge.evaluate(scored), abs=1e-9)


def test_class_metrics_equal_the_evaluator(scored):
    found = evaluation.class_metrics(scored, "target").first()
    for metric in evaluation.CLASS_METRICS:
        judge = MulticlassClassificationEvaluator(labelCol="target", predictionCol="prediction", metricName=metric)
        assert found[metric] == pytest.approx(judge.evaluate(scored), abs=1e-12)


def test_one_class_has_no_area(spark):
    rows = spark.createDataFrame([(1, 0.2, "a"), (1, 0.4, "a"), (0, 0.3, "b"), (1, 0.3, "b")], "target int, p double, g string")
    found = {r["g"]: r for r in evaluation.area_metrics(rows, "target", "p", ["g"]).collect()}
    assert found["a"]["areaUnderROC"] is None and found["a"]["areaUnderPR"] is None
    assert found["b"]["areaUnderROC"] == pytest.approx(0.5)


def test_ks_table_closes(spark, sf_dir):
    found = evaluation.ks_table(with_deciles(spark, sf_dir), "target", "p", groups=["ind_split"])
    assert tuple(found.columns[1:]) == evaluation.KS_COLUMNS
    last = found.where("decile = 10").collect()
    assert len(last) == 3
    for row in last:
        assert row["cum_pct_pos"] == pytest.approx(1) and row["cum_pct_neg"] == pytest.approx(1)
        assert row["ks"] == pytest.approx(0, abs=1e-12)


def test_periods_have_their_own_buckets(scored):
    rows = scored.where("ind_split = 'val'")
    found = evaluation.ks_by_period(rows, "target", "p", ["ident"], "month")
    sizes = found.groupBy("month").agg(F.max("n") - F.min("n"), F.count(F.lit(1)), F.sum("n")).collect()
    assert len(sizes) == 3 and all(r[1] <= 1 and r[2] == min(10, r[3]) for r in sizes)


def test_logit_is_clipped(spark):
    rows = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "p double").select(F.array(1 - F.col("p"), "p").alias("probability"))
    found = [r["score_alt"] for r in scoring.score_logit(rows, is_vector=False).collect()]
    assert found[1] == 0 and found[0] == pytest.approx(-found[2]) and all(map(math.isfinite, found))


def test_late_rescore_leaves_nothing_unless_per_date(spark, sf_dir):
    history = score_history(spark, sf_dir, late=True)
    assert latest_slice(history, "month").isEmpty()
    assert latest_slice(history, "month", per_date=True).count() > 0


@pytest.fixture(scope="module")
def train(spark, sf_dir):
    rows = split_dataset(spark, sf_dir).where("ind_split = 'train'").select("target", *NUMERIC, *TEXT)
    return rows.fillna("none", TEXT).cache()


def test_chi_square_equals_the_library(train):
    names = [c + "_i" for c in TEXT]
    indexed = StringIndexer(inputCols=TEXT, outputCols=names).fit(train).transform(train)
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(indexed)
    wanted = dict(zip(TEXT, ChiSquareTest.test(vectors, "v", "target").first()["statistics"].toArray()))
    found = {r["feature"]: r["chi2"] for r in selection.association(train, TEXT, "target").collect()}
    assert found == pytest.approx(wanted, rel=1e-6)


def test_association_ranges(train):
    rows = train.withColumn("same", F.col("target").cast("string")).withColumn("one", F.lit("x"))
    found = {r["feature"]: r for r in selection.association(rows, [*NUMERIC, *TEXT, "same", "one"], "target").collect()}
    assert all(0 <= r["cramer_v"] <= 1 + 1e-12 and r["mutual_information"] >= 0 and r["chi2"] >= 0 for r in found.values())
    assert found["same"]["cramer_v"] == pytest.approx(1) and found["one"]["chi2"] == 0
    p = train.agg(F.avg("target")).first()[0]
    assert found["same"]["mutual_information"] == pytest.approx(-p * math.log(p) - (1 - p) * math.log(1 - p))


def test_association_needs_both_classes(train):
    found = selection.association(train.where("target = 1"), TEXT, "target").collect()
    assert all(r["chi2"] == 0 and r["cramer_v"] == 0 and abs(r["mutual_information"]) < 1e-9 for r in found)


def test_chi_square_is_cut_and_sorted(train):
    stats = selection.association(train, [*NUMERIC, *TEXT], "target")
    found = selection.chi_square(stats, top=3).collect()
    assert len(found) == 3 and [r["chi2"] for r in found] == sorted((r["chi2"] for r in found), reverse=True)


def test_criteria(spark):
    report = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.15), ("d", 0.05)], "feature string, importance double")

    def kept(df):
        return sorted(r["feature"] for r in df.collect())

    assert kept(selection.top_criterion(report, "importance", 2)) == ["a", "b"]
    assert kept(selection.percentile_criterion(report, "importance", 0.75)) == ["a", "b"]
    assert kept(selection.percentile_criterion(report, "importance", 0.85)) == ["a", "b", "c"]
    assert kept(selection.threshold_criterion(report, "importance", 0.05)) == ["a", "b", "c"]
    assert kept(selection.perc_criterion(report, "importance", 0.3)) == ["a", "b"]


def test_no_python_in_the_plans(train):
    plan = selection.association(train, TEXT, "target")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
