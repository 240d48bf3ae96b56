"""Label tables: any number of labels, without bringing them to the driver."""

from __future__ import annotations

import collections

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidemark.operators import model, selection
from tidemark.plans import labels
from tidemark.plans.encode import fit_by_width, fit_encode


@pytest.fixture
def fetched(spark, monkeypatch):
    """Rows that each collect brought to the driver."""
    counts, frame = [], type(spark.range(0))

    def collect(self, real=frame.collect):
        rows = real(self)
        counts.append(len(rows))
        return rows

    monkeypatch.setattr(frame, "collect", collect)
    return counts


def test_a_million_labels(spark, fetched):
    # A third of all rows says one thing, and most labels occur once.
    rows = spark.range(1_500_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("c")
    )
    table = labels.fit_labels(rows, ["c"])
    assert table.sizes == {"c": 1_000_001}
    asked = rows.unionByName(spark.createDataFrame([(-1, None), (-2, "new")], "id long, c string"))
    found = table.index(asked)
    seen = found.agg(
        F.count_if((F.col("id") >= 0) & (F.col("id") % 3 == 0) & (F.col("c_idx") == 0)),
        F.count_distinct("c_idx"),
        F.max("c_idx"),
        F.count_if((F.col("id") < 0) & (F.col("c_idx") == 1_000_001)),
        F.count(F.lit(1)),
    ).first()
    assert tuple(seen) == (500_000, 1_000_002, 1_000_001, 2, 1_500_002)
    # Ties in label order.
    early = found.where("c in ('v1', 'v10', 'v100', 'v1000')").orderBy("c_idx").select("c").collect()
    assert [r["c"] for r in early] == ["v1", "v10", "v100", "v1000"]
    assert max(fetched) <= 4


def test_indexes_equal_the_library(spark):
    said = ["a", "b", "b", "c", "c", None, "d", "", "é", "c"]
    rows = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(zip(said, reversed(said)))], "id int, c string, d string")
    found = labels.fit_labels(rows, ["c", "d"]).index(rows)
    theirs = StringIndexer(inputCols=["c", "d"], outputCols=["ci", "di"], handleInvalid="keep").fit(rows).transform(rows)
    both = found.join(theirs.select("id", "ci", "di"), "id")
    assert both.where("c_idx != ci or d_idx != di").isEmpty()
    assert labels.fit_labels(rows.limit(0), ["c"]).index(rows).where("c_idx != 0").isEmpty()
    assert labels.fit_labels(rows, []).index(rows).columns == rows.columns


def test_rare_and_hot_labels_meet(spark, monkeypatch):
    """Both joins and the spreading between them, with a bound of two hot labels."""
    monkeypatch.setattr(labels, "HOT", 2)
    said = ["x"] * 50 + ["y"] * 20 + ["z", "z", "w", "v"] + [None] * 5
    rows = spark.createDataFrame(list(enumerate(said)), "id int, c string").repartition(3)
    table = labels.fit_labels(rows, ["c"])
    got = {r["id"]: r["c_idx"] for r in table.index(rows).collect()}
    place = {"x": 0, "y": 1, "z": 2, "v": 3, "w": 4, None: 5}
    assert got == {i: place[c] for i, c in enumerate(said)}
    table.save(table.folder + "-again")
    loaded = labels.LabelTable.load(spark, table.folder + "-again")
    assert loaded.sizes == table.sizes and loaded.index(rows).exceptAll(table.index(rows)).isEmpty()
    with pytest.raises(ValueError, match="two label tables"):
        labels.merged([table, loaded])


def test_features_and_names(spark):
    rows = spark.createDataFrame([(1, "a", 2.5, "p"), (0, None, None, "q"), (3, "b", 0.0, "p")], "n int, c string, x double, d string")
    table = labels.merged([labels.fit_labels(rows, ["c"]), labels.fit_labels(rows, ["d"])])
    made = table.features(rows, ["x", "c", "n", "d"]).orderBy("n").select(vector_to_array("features").alias("f")).collect()
    assert [str(r["f"]) for r in made] == ["[nan, 0.0, 0.0, 0.0, 0.0, 1.0]", "[2.5, 1.0, 1.0, 0.0, 1.0, 0.0]", "[0.0, 3.0, 0.0, 1.0, 1.0, 0.0]"]
    names = {r["position"]: (r["feature"], r["source"]) for r in table.names(["x", "c", "n", "d"]).collect()}
    assert names == {0: ("x", "x"), 1: ("n", "n"), 2: ("c_a", "c"), 3: ("c_b", "c"), 4: ("d_p", "d"), 5: ("d_q", "d")}
    hot = table.one_hot(rows).orderBy("n").select(vector_to_array("c_ohe")).collect()
    assert [r[0] for r in hot] == [[0, 0, 1], [1, 0, 0], [0, 1, 0]]


def test_models_use_text_features(spark):
    rows = spark.range(600).select(
        (F.col("id") % 7).cast("double").alias("x"),
        F.concat(F.lit("l"), F.col("id") % 40).alias("c"),
        (F.col("id") % 40 < 13).cast("int").alias("target"),
    )
    table = labels.fit_labels(rows, ["c"])
    fitted = model.train_gbt(rows, ["x", "c"], "target", table, maxIter=20)
    predicted = model.predict(fitted, rows, ["target"], ["x", "c"], table)
    assert predicted.where("prediction = target").count() > 450
    found = {r["feature"]: r["importance"] for r in model.gbt_importance(fitted, rows, ["x", "c"], table).collect()}
    assert len(found) == 41 and found["x"] < 0.5 and sum(found.values()) == pytest.approx(1)
    by = {r["feature"]: r["importance"] for r in selection.forest_importance(rows, ["x", "c"], "target", table).collect()}
    assert set(by) == {"x", "c"} and by["c"] > by["x"]


def test_wide_columns_get_tables_and_narrow_ones_plans(spark, fetched):
    rows = spark.range(3000).select(
        F.concat(F.lit("w"), "id").alias("wide"), (F.col("id") % 3).cast("string").alias("few"), F.lit(None).cast("string").alias("none")
    )
    plan, table = fit_by_width(rows, ["wide", "few", "none"], 100)
    assert plan.labels == {"few": ("0", "1", "2"), "none": ()} and table.sizes == {"wide": 3000}
    assert max(fetched) <= 3
    assert collections.Counter(plan.dummies(rows).columns) == collections.Counter(["wide", "few_0", "few_1", "few_2"])
    many = spark.range(21_000).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="too many columns"):
        fit_encode(many, ["c"])
