from __future__ import annotations

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.scores import bucket_of_rank
from tidemark.operators import ordering
from tidemark.operators.scoring import score_buckets
from tidemark.sources.staging import pinned


def skewed(spark, n=6000):
    """A third of the rows in one group and a third on one value."""
    k = F.col("id")
    return spark.range(n).select(
        k.alias("key"),
        F.when(k % 3 == 0, "hot").when(k % 97 == 1, None).otherwise(F.concat(F.lit("g"), k % 7)).alias("g"),
        F.when(k % 3 == 1, 0.5).otherwise((F.xxhash64(k) % 1000) / 1000.0).alias("v"),
    )


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ranked_equals_window(spark, partitions, groups):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = skewed(spark)
        found = ordering.ranked(rows, [F.desc("v"), F.asc("key")], groups, total="size")
        whole = Window.partitionBy(*(groups or [F.lit(0)]))
        wanted = rows.select(
            "*",
            F.count(F.lit(1)).over(whole).alias("size"),
            F.row_number().over(whole.orderBy(F.desc("v"), F.asc("key"))).cast("bigint").alias("rank"),
        )
        assert found.count() == rows.count()
        assert found.select(wanted.columns).exceptAll(wanted).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_group_is_split(spark):
    laid = ordering._laid_out(skewed(spark, 60_000), [F.desc("v"), F.asc("key")], ["g"])
    sizes = [r["count"] for r in laid.groupBy("_range").count().collect()]
    assert len(sizes) == 4
    assert max(sizes) < 1.5 * 60_000 / 4


def test_running_totals(spark):
    rows = skewed(spark).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    found = ordering.running_totals(rows, [F.desc("v")], {"upto": "n"}, ["g"], {"all": "n"})
    whole = Window.partitionBy("g")
    wanted = rows.select(
        "g", "v", "n", F.sum("n").over(whole).alias("all"), F.sum("n").over(whole.orderBy(F.desc("v"))).alias("upto")
    )
    assert found.select(wanted.columns).exceptAll(wanted).isEmpty()
    assert found.count() == wanted.count()


@pytest.mark.parametrize("interpolate", [False, True])
@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_are_exact(spark, interpolate, accuracy):
    """Accuracy 50 sends the hot group through the brackets, 10,000 none."""
    rows = skewed(spark, 30_000).unionByName(skewed(spark, 30).withColumn("v", F.lit(None).cast("double")))
    spots = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.9}
    found = ordering.quantiles(rows, ["g"], "v", spots, interpolate, accuracy=accuracy)
    rows.createOrReplaceTempView("quantile_rows")
    kind = "percentile_cont" if interpolate else "percentile_disc"
    columns = ", ".join(f"{kind}({p}) within group (order by v) as {n}" for n, p in spots.items())
    wanted = {r["g"]: r for r in spark.sql(f"select g, {columns} from quantile_rows group by g").collect()}
    got = {r["g"]: r for r in found.collect()}
    assert got.keys() == wanted.keys()
    for g, row in wanted.items():
        assert [got[g][n] for n in spots] == pytest.approx([row[n] for n in spots])


def test_column_quantiles_equal_quantiles(spark):
    rows = skewed(spark, 20_000).withColumn("w", F.when(F.col("key") % 5 > 0, F.col("key") % 301))
    spots = {"a": 0.1, "b": 0.5}
    found = ordering.column_quantiles(
        rows, ["g"], ["v", "w"], "column", spots, accuracy=50, step=1, extra=lambda c: [F.max(c).alias("top")]
    )
    for column in ("v", "w"):
        wanted = ordering.quantiles(rows, ["g"], column, spots)
        part = found.where(F.col("column") == column)
        assert part.select("g", "a", "b").exceptAll(wanted.select("g", "a", "b")).isEmpty()
        assert part.count() == wanted.count() and part.where("top < b").isEmpty()


def test_quantiles_of_nothing(spark):
    rows = spark.range(3).select(F.lit("x").alias("g"), F.lit(None).cast("double").alias("v"))
    assert ordering.quantiles(rows, ["g"], "v", {"m": 0.5}).collect() == [("x", None)]
    assert ordering.quantiles(rows.limit(0), ["g"], "v", {"m": 0.5}).isEmpty()


@pytest.mark.parametrize("n,buckets", [(1, 10), (7, 10), (10, 10), (23, 10), (100, 7)])
def test_bucket_of_rank_is_ntile(spark, n, buckets):
    rows = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).cast("bigint").alias("n"))
    found = rows.select(
        bucket_of_rank("r", "n", buckets).alias("b"),
        F.ntile(buckets).over(Window.partitionBy("n").orderBy("r")).alias("w"),
    )
    assert found.where("b <> w").isEmpty()


def test_large_offsets_join_by_shuffle(spark, monkeypatch):
    """Beyond the pinned size, and with no broadcast at all, the answers stay the same."""
    rows = skewed(spark, 30_000)
    spots = {"a": 0.25, "b": 0.5}

    def answers():
        places = ordering.ranked(rows, [F.desc("v"), F.asc("key")], ["g"], total="size")
        found = ordering.quantiles(rows, ["g"], "v", spots, accuracy=50)
        return (
            sorted(places.select("key", "rank", "size").collect()),
            sorted((str(r["g"]), r["a"], r["b"]) for r in found.collect()),
        )

    wanted = answers()
    monkeypatch.setattr(ordering, "pinned", lambda df, *_: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert answers() == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucket_sizes_differ_by_one(spark):
    sizes = [
        r["count"]
        for r in score_buckets(skewed(spark, 1003), "v", ["key"], buckets=10, name="d").groupBy("d").count().collect()
    ]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_approximate_buckets_share_ties(spark):
    found = score_buckets(skewed(spark, 3000), "v", ["key"], ["g"], buckets=10, error=0.001, name="d")
    assert found.count() == 3000
    assert found.groupBy("g", "v").agg(F.count_distinct("d").alias("k")).where("k > 1").isEmpty()
    overall = score_buckets(skewed(spark, 3000), "v", ["key"], buckets=10, error=0.001, name="d")
    assert overall.agg(F.min("d"), F.max("d")).first() == (1, 10)


def test_pinned_keeps_all_rows(spark):
    rows = spark.range(11)
    assert sorted(r["id"] for r in pinned(rows).collect()) == list(range(11))


def test_ranges_need_no_single_partition(spark):
    found = ordering.ranked(skewed(spark), [F.desc("v"), F.asc("key")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan
    assert math.isclose(found.agg(F.max("rank")).first()[0], 6000)
