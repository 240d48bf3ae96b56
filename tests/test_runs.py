"""A run counts once, wherever an earlier try of it stopped."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F
from tidemark.sources import lake


@pytest.fixture(scope="module")
def schema(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE runs LOCATION '{tmp_path_factory.mktemp('runs')}'")
    return "runs"


def rows(spark, month, n=50):
    return spark.range(n).select("id", (F.col("id") * 1.5).alias("score"), F.lit(month).alias("month"))


def test_a_try_that_dies_before_it_is_named_counts_for_nothing(spark, schema, monkeypatch):
    name = f"{schema}.scores"
    assert lake.append_run(rows(spark, "2001-01"), name, "a-1", ["month"])

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(lake, "_name_run", die)
        with pytest.raises(RuntimeError, match="killed"):
            lake.append_run(rows(spark, "2001-02"), name, "a-2", ["month"])
    assert spark.table(name).count() == 100 and lake.committed_rows(spark, name).count() == 50
    assert lake.append_run(rows(spark, "2001-02"), name, "a-2", ["month"])
    assert not lake.append_run(rows(spark, "2001-02"), name, "a-2", ["month"])
    known = lake.committed_rows(spark, name)
    assert known.count() == 100 and known.columns == ["id", "score", "month"]
    assert lake.sweep_runs(spark, name) == 1 and spark.table(name).count() == 100 and lake.committed_rows(spark, name).count() == 100


def test_a_first_try_that_dies(spark, schema, monkeypatch):
    name = f"{schema}.first"
    with monkeypatch.context() as patch:
        patch.setattr(lake, "_name_run", lambda *_: None)
        lake.append_run(rows(spark, "2001-01"), name, "r")
    assert lake.committed_rows(spark, name).isEmpty()
    lake.append_run(rows(spark, "2001-01", 7), name, "r")
    assert lake.committed_rows(spark, name).count() == 7


def test_of_two_tries_that_end_together_one_counts(spark, schema):
    name = f"{schema}.twins"
    lake.append_run(rows(spark, "2001-01", 5), name, "r")
    lake.append_or_create(rows(spark, "2001-01", 9).withColumn(lake.RUN_PART, F.lit("r-other")), name)
    lake._name_run(spark, name, "r", "r-other")
    assert lake.committed_rows(spark, name).count() == 5 and len(lake.committed_runs(spark, name)) == 1


def test_only_named_partitions_are_read(spark, schema):
    name = f"{schema}.pruned"
    for run in ("a", "b"):
        lake.append_run(rows(spark, run, 3), name, run, ["month"])
    plan = lake.committed_rows(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [run_part" in plan or "run_part" in plan.split("PartitionFilters")[1][:200]
