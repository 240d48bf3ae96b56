from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidemark.operators import audit, merge, profile, selection
from tidemark.options import Options, SpineColumns
from tidemark.plans import clean
from tidemark.plans.clean import CleanPlan, fit_clean
from tidemark.plans.encode import EncodePlan, fit_encode
from workloads.fixtures import DIRTY, KEYS, OPTIONS, SPINE, TEXT, dataset, split_dataset


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return dataset(spark, sf_dir).cache()


def test_dominant_share_equals_exact_mode_share(rows):
    columns = [*DIRTY, *TEXT]
    first = profile.first_look(rows, columns, 5)
    second = profile.second_look(rows, columns, first, 3)
    for row in profile.mode_profile(rows, columns).collect():
        if row["mode_share"] > 0.6:
            assert second[row["column"]]["share"] == pytest.approx(row["mode_share"])
        elif row["column"] in second:
            assert second[row["column"]]["share"] <= row["mode_share"] + 1e-12


def test_fit_drops_and_encodes(rows):
    plan = clean.fit_clean(rows, OPTIONS)
    assert plan.dropped == {
        "constant_txt": "constant", "all_null": "nulls", "mostly_null": "nulls", "quasi_const": "constant"
    } or plan.dropped.keys() >= {"constant_txt", "all_null"}
    assert plan.binary == {"flag_yn": ("N", "Y"), "two_level": (3, 7)} | (
        {"quasi_const": ("A", "B")} if "quasi_const" in plan.columns else {}
    )
    assert plan.plain_binary == ("flag_01",)
    assert not set(plan.dropped) & set(OPTIONS.spine.all())
    again = clean.CleanPlan.from_json(plan.to_json())
    assert again == plan
    found = again.transform(rows)
    assert found.count() == rows.count()
    holes = found.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in found.columns]).first().asDict()
    assert not any(holes.values())
    assert found.schema["flag_yn"].dataType.simpleString() == "int"
    labels = [r["messy"] for r in found.select("messy").distinct().collect()]
    assert all(label.replace("_", "").isalnum() and label == label.upper() for label in labels)


def test_production_uses_the_fitted_values(spark, rows):
    """One value only in production: the fitted map still applies; unseen text stays null and is filled."""
    plan = clean.fit_clean(rows.select(*KEYS, "flag_yn", "two_level"), OPTIONS)
    later = spark.createDataFrame([(1, date(2020, 1, 1), " y", 7), (2, date(2020, 1, 1), "?", None)], "ident long, month date, flag_yn string, two_level int")
    assert [(r["flag_yn"], r["two_level"]) for r in plan.transform(later).orderBy("ident").collect()] == [(1, 1), (0, 0)]


def test_bin_input_becomes_text(rows):
    plan = clean.fit_clean(rows.select(*KEYS, "flag_yn", "flag_01"), replace(OPTIONS, bin_input=("flag_yn",)))
    found = {r[0] for r in plan.transform(rows).select("flag_yn").distinct().collect()}
    assert found <= {"0", "1", "SIN_INFO"}


def test_fit_on_train_only(spark, sf_dir):
    rows = split_dataset(spark, sf_dir)
    marked = rows.withColumn("late", F.when(F.col("ind_split") == "val", 1.0))
    assert "late" in clean.fit_clean(marked, replace(OPTIONS, fit_on="train")).dropped


def test_low_threshold_uses_exact_modes(rows):
    plan = clean.fit_clean(rows.select(*KEYS, "flag_yn", "segment"), replace(OPTIONS, null_threshold=0.4))
    assert plan.dropped == {"flag_yn": "constant"}


def test_low_variance_is_opt_in(rows):
    assert "two_level" in clean.fit_clean(rows.select(*KEYS, "two_level", "c_acctbal"), OPTIONS).columns
    plan = clean.fit_clean(rows.select(*KEYS, "two_level", "c_acctbal"), OPTIONS, low_variance=True)
    assert plan.dropped == {"two_level": "variance"}


def test_label_order_equals_string_indexer(rows):
    filled = clean.fill_nulls(rows.select(*TEXT))
    plan = fit_encode(filled, TEXT)
    model = StringIndexer(inputCols=TEXT, outputCols=[c + "_i" for c in TEXT], stringOrderType="frequencyDesc").fit(filled)
    assert [list(v) for v in plan.labels.values()] == [list(v) for v in model.labelsArray]


def test_unseen_labels(spark):
    plan = EncodePlan({"a": ("x", "y"), "b": ("p",)})
    rows = spark.createDataFrame([("x", "p"), ("z", "q"), ("y", "p")], "a string, b string")
    indexed = plan.indexer().transform(rows).collect()
    assert [(r["a_idx"], r["b_idx"]) for r in indexed] == [(0.0, 0.0), (2.0, 1.0), (1.0, 0.0)]
    flags = plan.dummies(rows).collect()
    assert [tuple(r) for r in flags] == [(1, 0, 1), (0, 0, 0), (0, 1, 1)]
    assert plan.original_features(["a_x", "n", "a_y", "b_p"]) == ["a", "n", "b"]
    assert EncodePlan.from_json(plan.to_json()) == plan


def test_colliding_dummies_are_an_error(spark):
    rows = spark.createDataFrame([("b_C", "C")], "a string, a_b string")
    with pytest.raises(ValueError, match="a_b_c"):
        EncodePlan({"a": ("b_C",), "a_b": ("C",)}).dummies(rows)


def test_too_many_labels_is_an_error(spark):
    rows = spark.range(50).select(F.col("id").cast("string").alias("wide"), F.lit("k").alias("narrow"))
    with pytest.raises(ValueError, match="wide"):
        fit_encode(rows, ["wide", "narrow"], max_labels=49)
    assert len(fit_encode(rows, ["wide", "narrow"], max_labels=50).labels["wide"]) == 50


def test_merge_refuses_clashing_columns(spark):
    left = spark.range(3).withColumn("x", F.lit(1))
    with pytest.raises(ValueError, match="x"):
        merge.join_features(left, left, ["id"])


def test_audit_keeps_every_row(rows):
    found = audit.audit_categorical(rows, "month", TEXT, top=2)
    per_month = {r["month"]: r["count"] for r in rows.groupBy("month").count().collect()}
    sums = found.groupBy("month", "variable").agg(F.sum("n").alias("n"), F.sum("pct").alias("p")).collect()
    assert len(sums) == len(per_month) * len(TEXT)
    assert all(r["n"] == per_month[r["month"]] and r["p"] == pytest.approx(1) for r in sums)
    assert found.where("rest").count() > 0 and found.where("rest and value is not null").count() == 0
    assert "rest" not in audit.audit_categorical(rows, "month", TEXT).columns


def test_booleans_and_decimals_are_cleaned(spark):
    base = spark.range(200).select(
        F.col("id").alias("ident"), F.lit("2000-01-01").cast("date").alias("month"), F.lit(1).alias("target"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 2 == 0).alias("yes"),
        F.when(F.col("id") % 2 == 0, 1.5).otherwise(2.5).cast("decimal(10,2)").alias("price"),
    )
    plan = fit_clean(base, Options(spine=SPINE))
    assert set(plan.binary) == {"price"} and plan.plain_binary == ("yes",)
    again = CleanPlan.from_json(plan.to_json())
    assert again == plan
    done = again.transform(base)
    assert done.where("yes is null or price is null").count() == 0
    assert {r["price"] for r in done.collect()} == {0, 1} and "yes" in profile.numeric_columns(done)


def test_many_labels_are_kept(spark):
    rows = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("c"))
    assert len(fit_encode(rows, ["c"]).labels["c"]) == 5000


def test_flags_keep_their_association(spark):
    """Complementing or relabelling a two-valued column changes nothing."""
    i = F.col("id")
    rows = spark.range(1000).select(
        (i % 10 > 0).cast("int").alias("target"), (i % 10 > 0).cast("int").alias("same"), (i % 10 == 0).cast("int").alias("other"),
        F.when(i % 10 > 0, 50).otherwise(i % 3).alias("peak"), (i % 7).alias("noise"),
    )
    found = {r["feature"]: r for r in selection.association(rows, ["same", "other", "peak", "noise"], "target").collect()}
    assert found["same"]["cramer_v"] == pytest.approx(1) and found["other"]["cramer_v"] == pytest.approx(1)
    assert found["peak"]["cramer_v"] == pytest.approx(1)
    assert found["same"]["mutual_information"] == pytest.approx(found["other"]["mutual_information"])


def test_audit_approximate_close_to_exact(rows):
    exact = {(r["month"], r["variable"]): r for r in audit.audit_numeric(rows, "month", ["c_acctbal"]).collect()}
    near = audit.audit_numeric(rows, "month", ["c_acctbal"], error=0.001).collect()
    assert len(near) == len(exact)
    for r in near:
        e = exact[(r["month"], r["variable"])]
        assert r["n"] == e["n"] and e["min"] <= r["p50"] <= e["max"]


def test_top_values_are_cut_before_the_shuffle(rows):
    plan = audit.audit_categorical(rows, "month", TEXT, top=100)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan


def test_families(rows):
    assert set(profile.string_columns(rows, KEYS)) == {*TEXT, "messy", "constant_txt", "quasi_const", "flag_yn"}
    assert "c_acctbal" in profile.numeric_columns(rows, KEYS) and "ident" not in profile.numeric_columns(rows, KEYS)
    assert SpineColumns().keys == ["cliident", "data_date_part"] and Options().train_size == 0.7 and SPINE.ident == "ident"


def test_heavy_values_are_found_without_shuffling_values(spark, monkeypatch):
    rows = spark.range(60_000).select(
        F.concat(F.lit("v"), F.col("id")).alias("all_different"),
        F.when(F.col("id") % 10 < 4, "often").when(F.col("id") % 10 < 7, None).otherwise(F.col("id").cast("string")).alias("four_tenths"),
        F.when(F.col("id") % 2 == 0, 1.5).otherwise(2.5).alias("halves"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") < 18_000, 3).otherwise(F.col("id")).alias("just_not"),
    )
    found = profile.heavy_values(rows, rows.columns, 0.3).collect()
    assert {(r["column"], r["value"], r["n"]) for r in found} == {
        ("four_tenths", "often", 24_000), ("halves", "1.5", 30_000), ("halves", "2.5", 30_000)
    }
    assert {r["share"] for r in found} == {0.4, 0.5}
    assert profile.heavy_values(rows.limit(0), rows.columns, 0.3).isEmpty()
    # Slots that many values share are looked into further.
    monkeypatch.setattr(profile, "_SLOT_BITS", 1)
    again = profile.heavy_values(rows, rows.columns, 0.3).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    plan = fit_clean(rows.withColumns({"ident": F.lit(1), "month": F.lit(1)}), Options(spine=SpineColumns(ident="ident", date="month"), null_threshold=0.39))
    assert plan.dropped == {"nothing": "nulls", "four_tenths": "constant", "halves": "constant"}
