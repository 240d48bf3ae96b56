"""Boosted trees as expressions and text: the model, Spark and DuckDB give one score."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array

from pyspark.sql import functions as F
from tidemark.operators import model
from tidemark.plans import labels
from tidemark.plans.trees import TreePlan


def rows(spark):
    return spark.range(3000).select(
        F.col("id"),
        F.sin(F.col("id") * 0.7).alias("a wave"),
        (F.col("id") % 11).alias("b"),
        (F.col("id") % 5 == 0).cast("int").alias("c_X"),
        F.lit(1.0).alias("flat"),
        ((F.sin(F.col("id") * 0.7) > 0.2) != (F.col("id") % 11 > 6)).cast("int").alias("target"),
    )


def test_model_expression_and_text_agree(spark):
    data, features = rows(spark), ["flat", "a wave", "b", "c_X"]
    fitted = model.train_gbt(data, features, "target", maxIter=12, maxDepth=4)
    plan = TreePlan.from_json(TreePlan.of(fitted).to_json())
    assert plan == TreePlan.of(fitted) and set(plan.used()) <= {"a wave", "b", "c_X"}
    known = fitted.transform(data).select("id", vector_to_array("probability")[1].alias("p"), F.col("prediction").alias("said"))
    both = plan.score(data, ["id"]).join(known, "id")
    assert both.count() == 3000 and both.where("abs(p - score) > 1e-12 or said != prediction").isEmpty()
    assert 0.9 < both.join(data, "id").agg(F.avg((F.col("target") == F.col("prediction")).cast("double"))).first()[0]
    table = data.toArrow()
    con = duckdb.connect()
    con.register("data", table)
    told = con.sql(plan.sql("data", ["id"])).to_arrow_table().to_pydict()
    want = {r["id"]: (r["p"], r["said"]) for r in known.collect()}
    assert len(told["id"]) == 3000
    for i, score, said in zip(told["id"], told["score"], told["prediction"]):
        assert score == pytest.approx(want[i][0], abs=1e-12) and said == want[i][1]


def test_equal_rows_are_read_once(spark, monkeypatch):
    # Below 10,000 rows all of them, and no sample, give the places where trees may split.
    data = rows(spark).where("id < 2500").withColumn("copies", F.when(F.col("id") % 5 == 1, 9).otherwise(F.col("id") % 3 + 1))
    data = data.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    features = ["b", "c_X", "flat", "a wave"]
    seen = []
    plain = model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda trees, df: seen.append(df) or plain(trees, df))
    fitted = model.train_gbt(data, features, "target", maxIter=8, maxDepth=4).stages[-1]
    handed = seen[-1]
    assert handed.count() == 2500 and handed.agg(F.sum(model.WEIGHT)).first()[0] == data.count()
    assert handed.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    # Of all rows one by one the same trees come, up to the order of sums.
    whole = VectorAssembler(inputCols=features, outputCol="features").transform(data)
    size = model.MODEL_SIZE | {"maxIter": 8, "maxDepth": 4}
    other = Pipeline(stages=[model.GBTClassifier(labelCol="target", seed=model.SEED, **size)]).fit(whole).stages[-1]
    both = fitted.transform(whole).select("id", "copy", vector_to_array("probability")[1].alias("p")).join(
        other.transform(whole).select("id", "copy", vector_to_array("probability")[1].alias("q")), ["id", "copy"]
    )
    assert both.count() == data.count() and both.where("abs(p - q) > 1e-9").isEmpty()
    # A share of the rows, or a number of rows in a leaf, is of rows and not of different rows.
    for size in ({"subsamplingRate": 0.5}, {"minInstancesPerNode": 20}):
        model.train_gbt(data, features, "target", maxIter=1, maxDepth=1, **size)
        assert seen[-1].count() == data.count() and model.WEIGHT not in seen[-1].columns


def test_many_rows_are_binned(spark, monkeypatch, tmp_path):
    data = rows(spark).withColumns(
        {"money": F.col("id").cast("decimal(9,2)"), "yes": F.col("id") % 3 == 0, "wide": F.col("id") * 7 - 9000}
    )
    features = ["flat", "a wave", "b", "c_X", "money", "yes", "wide"]
    seen = []
    plain = model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda trees, df: seen.append(df) or plain(trees, df))
    assert len(model.train_gbt(data, features, "target", maxIter=1).stages) == 2
    monkeypatch.setattr(model, "BINNED_FROM", 2999)
    fitted = model.train_gbt(data.select("target", *features), ["a wave", "b"], "target", maxIter=12, maxDepth=4)
    # 32 bins of one number, 11 values of the other and two classes, of all rows.
    assert seen[-1].count() <= 32 * 11 * 2 and seen[-1].agg(F.sum(model.WEIGHT)).first()[0] == 3000
    fitted = model.train_gbt(data, features, "target", maxIter=12, maxDepth=4)
    (bins,) = [s for s in fitted.stages if isinstance(s, Bucketizer)]
    assert model.model_columns(fitted) == features and bins.getInputCols() == ["flat", "a wave", "money", "wide"]
    assert all(len(edges) <= 33 for edges in bins.getSplitsArray())
    # Every tree splits at a threshold between bins that hold near as many rows.
    waves = bins.transform(data).groupBy("_bin_1").count()
    assert waves.agg(F.max("count")).first()[0] < 1.2 * 3000 / 32
    fitted.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    plan = TreePlan.of(again)
    known = fitted.transform(data).select("id", vector_to_array("probability")[1].alias("p"), F.col("prediction").alias("said"))
    both = plan.score(data, ["id"]).join(known, "id")
    assert both.count() == 3000 and both.where("abs(p - score) > 1e-12 or said != prediction").isEmpty()
    assert 0.9 < known.join(data, "id").agg(F.avg((F.col("target") == F.col("said")).cast("double"))).first()[0]
    ranked = {r["feature"] for r in model.gbt_importance(fitted, data).collect()}
    assert ranked <= set(features) and {"a wave", "b"} <= ranked
    # What the trees refuse of few rows they refuse of many.
    for odd in (None, float("nan"), float("inf"), float("-inf")):
        for limit in (2999, 3000):
            monkeypatch.setattr(model, "BINNED_FROM", limit)
            spoilt = data.withColumn("a wave", F.when(F.col("id") == 7, F.lit(odd)).otherwise(F.col("a wave")))
            with pytest.raises(Exception, match="(?i)null|nan|infinit"):
                model.train_gbt(spoilt, ["a wave", "b"], "target", maxIter=1, maxDepth=1)


def test_odd_training_rows(spark):
    """Equal rows alone give the trees no split; a null is refused as before."""
    alike = spark.range(50).select(F.lit(2.0).alias("x"), (F.col("id") * 0 + 1).cast("int").alias("target"))
    only = model.train_gbt(alike, ["x"], "target", maxIter=2)
    assert all(t.depth == 0 for t in only.stages[-1].trees)
    for odd in ("x", "target"):
        with pytest.raises(Exception, match="(?i)null"):
            model.train_gbt(alike.withColumn(odd, F.when(F.rand(1) > 0.2, F.col(odd))), ["x"], "target", maxIter=1)


def test_odd_values_go_right(spark):
    plan = TreePlan(("x", "y"), (1.0, 0.5), (("x", 0.5, ("y", -1e-7, 1.0, 2.0), 4.0), -1.5))
    data = spark.createDataFrame([(0, 0.5, -1.0), (1, 0.4, None), (2, None, 0.0), (3, float("nan"), -5.0), (4, 0.0, -1e-7)], "id int, x double, y double")
    want = {0: 0.25, 1: 1.25, 2: 3.25, 3: 3.25, 4: 0.25}
    got = {r["id"]: r["score"] for r in plan.score(data, ["id"]).collect()}
    assert got == pytest.approx({i: 1 / (1 + math.exp(-2 * m)) for i, m in want.items()})
    data.createOrReplaceTempView("odd_rows")
    again = {r["id"]: r["score"] for r in spark.sql(plan.sql("odd_rows", ["id"], "`")).collect()}
    assert again == got
    only = TreePlan(("x",), (2.0,), (0.0,))
    assert {(r["score"], r["prediction"]) for r in only.score(data, []).collect()} == {(0.5, 0.0)} and only.used() == []


def test_text_features_by_name(spark):
    data = rows(spark).withColumn("t", F.concat(F.lit("v"), F.col("b")))
    table = labels.fit_labels(data, ["t"])
    fitted = model.train_gbt(data, ["a wave", "t"], "target", table, maxIter=3)
    names = [r["feature"] for r in table.names(["a wave", "t"]).orderBy("position").collect()]
    plan = TreePlan.of(fitted, names)
    wide = data.select("id", "a wave", *[(F.col("t") == n[2:]).cast("int").alias(n) for n in names[1:]])
    known = fitted.transform(table.features(data, ["a wave", "t"])).select("id", vector_to_array("probability")[1].alias("p"))
    assert plan.score(wide, ["id"]).join(known, "id").where("abs(p - score) > 1e-12").isEmpty()


def test_other_models_are_refused(spark):
    assembler = VectorAssembler(inputCols=["b"], outputCol="features")
    other = Pipeline(stages=[assembler, DecisionTreeClassifier(labelCol="target")]).fit(rows(spark))
    with pytest.raises(ValueError, match="no boosted trees"):
        TreePlan.of(other)
