"""The last run from the catalog's partitions equals the one from the rows."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F
from tidemark import jobs
from tidemark.options import Options
from tidemark.sources import lake

ROWS = [
    (1, "2001-06-01", "20010701_000000"),
    (2, "2001-07-01", "20010701_000000"),
    (3, "2001-07-01", "20010801_000000"),
    (4, "2001-06-01", "20010901_000000"),
    (5, None, "20010801_000000"),
]


@pytest.fixture(scope="module")
def schema(spark, tmp_path_factory):
    spark.sql(f"CREATE DATABASE slices LOCATION '{tmp_path_factory.mktemp('slices')}'")
    return "slices"


def saved(spark, name, rows, by, kind="date", stamps="string"):
    df = spark.createDataFrame(rows, "id long, month string, exec_time string")
    df = df.select("id", F.col("month").cast(kind).alias("month"), F.col("exec_time").cast(stamps).alias("exec_time"))
    lake.append_or_create(df, name, by)
    return spark.table(name)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("by", [[], ["month"], ["exec_time"], ["month", "exec_time"], ["exec_time", "month"]])
def test_equals_the_slice_of_the_rows(spark, schema, by):
    name = f"{schema}.by_{'_'.join(by)}"
    table = saved(spark, name, ROWS, by)
    for per_date, expected in ((False, []), (True, [3])):
        found = lake.last_slice(spark, name, "month", per_date=per_date)
        assert ids(found) == ids(lake.latest_slice(table, "month", per_date=per_date)) == expected
        assert found.columns == table.columns


def test_reads_one_partition(spark, schema):
    name = f"{schema}.pruned"
    saved(spark, name, [r for r in ROWS if r[0] != 4], ["month", "exec_time"])
    for per_date in (False, True):
        found = lake.last_slice(spark, name, "month", per_date=per_date)
        assert [r["id"] for r in found.collect()] == [3]
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        assert scan.metrics().apply("numPartitions").value() == 1
    kept = f"{schema}.by_period"
    saved(spark, kept, [r for r in ROWS if r[0] != 4], ["month"])
    found = lake.last_slice(spark, kept, "month", per_date=True)
    assert ids(found) == [3] and "PartitionFilters: [isnotnull(month" in found._jdf.queryExecution().toString()


def test_odd_values_and_types(spark, schema):
    odd = [(1, "a", "x=y/z 10:00%+"), (2, "b", "x"), (3, "b", "x=y/z 10:00%+"), (4, "b=+ %2B", "w")]
    table = saved(spark, f"{schema}.odd", odd, ["month", "exec_time"], "string")
    listed = lake.partitions(spark, f"{schema}.odd")
    assert sorted(map(tuple, listed.collect())) == sorted((m, t) for _, m, t in odd)
    assert ids(lake.last_slice(spark, f"{schema}.odd", "month", per_date=True)) == [4]
    assert ids(lake.last_slice(spark, f"{schema}.odd", "month")) == ids(lake.latest_slice(table, "month")) == []
    # Whole numbers order as numbers, times as times.
    saved(spark, f"{schema}.typed", [(1, "9", "2001-01-01 09:30:00"), (2, "10", "2001-01-01 10:30:00.5")], ["month", "exec_time"], "int", "timestamp")
    assert ids(lake.last_slice(spark, f"{schema}.typed", "month")) == [2]


def test_partitions_without_rows(spark, schema):
    name = f"{schema}.hollow"
    saved(spark, name, ROWS[:3], ["month", "exec_time"])
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (month = '2002-01-01', exec_time = '20020101_000000')")
    assert lake.partitions(spark, name).count() == 4
    for per_date in (False, True):
        assert ids(lake.last_slice(spark, name, "month", per_date=per_date)) == [3]
    empty = f"{schema}.empty"
    saved(spark, empty, [], ["month", "exec_time"])
    assert ids(lake.last_slice(spark, empty, "month")) == [] == ids(lake.last_slice(spark, empty, "month", per_date=True))


def test_runs_that_did_not_end_are_not_the_last(spark, schema, monkeypatch):
    name = f"{schema}.runs"

    def run(month, stamp):
        df = spark.range(3).select("id", F.lit(month).cast("date").alias("month"), F.lit(stamp).alias("exec_time"))
        lake.append_run(df, name, stamp, ["month", "exec_time"])

    run("2001-06-01", "1")
    run("2001-07-01", "2")
    with monkeypatch.context() as patch:
        patch.setattr(lake, "_name_run", lambda *_: None)
        run("2001-08-01", "3")
    found = lake.last_slice(spark, name, "month")
    assert found.columns == ["id", "month", "exec_time"]
    assert {(str(r["month"]), r["exec_time"]) for r in found.collect()} == {("2001-07-01", "2")} and found.count() == 3


def test_evaluation_of_the_last_run(spark, schema, tmp_path):
    """Outcomes follow the scores of the last run and contradict those of the one before."""
    options = Options()
    s = options.spine
    setup = jobs.Setup(options, schema, {}, {"prod": "evaluated"}, str(tmp_path))
    people = spark.range(40).select(F.col("id").alias(s.ident), (F.col("id") / 40).alias("p"))
    for month, stamp, p in (("2001-06-01", "1", 1 - F.col("p")), ("2001-07-01", "2", F.col("p"))):
        scored = people.select(
            s.ident, F.lit(month).cast("date").alias(s.date), p.alias(options.score_col), F.lit(1.0).alias("prediction"),
            (F.floor(p * 10) + 1).cast("int").alias(options.buckets_name), F.lit(stamp).alias("exec_time"),
        )
        lake.append_run(scored, f"{schema}.evaluated", stamp, [s.date, "exec_time"])
    both = people.select(s.ident, (F.col("p") >= 0.5).cast("int").alias(s.target), F.explode(F.array(F.lit("2001-06-01"), F.lit("2001-07-01"))).alias(s.date))
    both.write.saveAsTable(f"{schema}.known")
    jobs.evaluate(spark, setup, f"{schema}.known")
    metrics = lake.read_report(spark, setup.path("prod", "metrics"), "metric_name string, value double")
    assert dict(map(tuple, metrics.collect()))["areaUnderROC"] == 1.0
