"""Profiles merged from the states of periods equal profiles of all rows."""

from __future__ import annotations

import datetime
import random

import pytest

from pyspark.sql import functions as F
from tidemark import Options, SpineColumns
from tidemark.operators import profile, state
from tidemark.plans.clean import CleanPlan, fit_clean

COLUMNS = ["x", "k", "t", "none", "day"]


def rows(spark, n=4000):
    r = random.Random(5)
    start = datetime.date(2020, 1, 1)
    data = [
        (
            r.choice([None, *[start + datetime.timedelta(31 * i) for i in range(6)]]),
            r.choice([None, r.gauss(1e6, 3)]),
            r.randrange(700),
            r.choice([None, f"t{r.randrange(900)}"]),
            None,
            start + datetime.timedelta(r.randrange(50)),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "month date, x double, k int, t string, none double, day date").repartition(5)


def test_merged_states_equal_one_profile(spark):
    df = rows(spark)
    merged = {r["column"]: r for r in state.merge_state(state.profile_state(df, "month", COLUMNS, 0.01, step=2)).collect()}
    assert set(merged) == set(COLUMNS) and {r["n"] for r in merged.values()} == {4000}
    nulls = {r["column"]: r["null_share"] for r in profile.null_profile(df, COLUMNS).collect()}
    assert {c: r["null_share"] for c, r in merged.items()} == pytest.approx(nulls)
    for population, name in ((True, "var_pop"), (False, "var_samp")):
        for r in profile.variance_profile(df, ["x", "k", "none"], population).collect():
            assert merged[r["column"]][name] == (None if r["variance"] is None else pytest.approx(r["variance"], rel=1e-6))
    exact = {r["column"]: r["n_distinct"] for r in profile.mode_profile(df, COLUMNS).collect()}
    assert all(abs(merged[c]["n_distinct"] - exact[c]) <= 0.03 * exact[c] for c in COLUMNS)
    low = df.agg(F.min("x"), F.max("k"), F.min("t"), F.max("t")).first()
    assert (merged["x"]["low_number"], merged["k"]["high_number"], merged["t"]["low_text"], merged["t"]["high_text"]) == tuple(low)
    assert merged["t"]["mean"] is None and merged["day"]["low_text"] == "2020-01-01"
    assert state.merge_state(state.profile_state(df.limit(0), "month", COLUMNS)).isEmpty()


def test_a_new_month_is_added_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE profiles LOCATION '{tmp_path}'")
    df, name = rows(spark), "profiles.kept"
    early = df.where("month < '2020-03-01' or month is null")
    state.keep_state(spark, name, early, "month", COLUMNS)
    # Old months are not read again: what stands in them now would raise an error.
    late = df.withColumn("k", F.when((F.col("month") < "2020-03-01") | F.col("month").isNull(), F.raise_error(F.lit("read"))).otherwise(F.col("k")))
    kept = state.keep_state(spark, name, late, "month", COLUMNS)
    for _ in range(2):
        pairs = [state.merge_state(s).orderBy("column").collect() for s in (kept, state.profile_state(df, "month", COLUMNS))]
        for a, b in zip(*pairs, strict=True):
            assert a["column"] == b["column"] and abs(a["n_distinct"] - b["n_distinct"]) <= 0.01 * b["n_distinct"]
            assert list(a)[1:3] + list(a)[4:] == [x if x is None or isinstance(x, str) else pytest.approx(x) for x in list(b)[1:3] + list(b)[4:]]
        kept = state.keep_state(spark, name, df, "month", COLUMNS)
    some = state.merge_state(state.of_periods(kept, [datetime.date(2020, 1, 1)])).first()
    assert some["n"] == df.where("month = '2020-01-01'").count()


def test_rsd_is_the_error_of_the_sketches(spark):
    df = spark.range(200_000).select(F.lit(1).alias("month"), F.col("id").alias("k"))
    sizes = [state.profile_state(df, "month", ["k"], rsd).select(F.octet_length("distinct")).first()[0] for rsd in (0.1, 0.01)]
    assert sizes[0] < sizes[1] / 20
    with pytest.raises(ValueError, match="finer"):
        state.profile_state(df, "month", ["k"], 1e-9)


def test_date_columns_are_dropped_for_nulls_and_one_value(spark):
    day = datetime.date(2021, 5, 5)
    data = [(i, day, i % 2, None if i < 99 else day, day, day if i % 2 else datetime.date(2020, 1, 1)) for i in range(100)]
    df = spark.createDataFrame(data, "ident long, month date, target int, gone date, same date, two date")
    plan = fit_clean(df, Options(spine=SpineColumns(ident="ident", date="month")))
    assert plan.dropped == {"gone": "nulls", "same": "constant"} and plan.columns == ("two",) and not plan.binary
    again = CleanPlan.from_json(plan.to_json()).transform(df)
    assert again.schema["two"].dataType.typeName() == "date" and again.count() == 100
