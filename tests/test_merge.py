"""The windowed merge: one shuffle per source, checked keys, hot keys of the frame."""

from __future__ import annotations

import re

import pytest
from pyspark.errors import SparkRuntimeException

from pyspark.sql import functions as F
from tidemark.functions.dates import month_window
from tidemark.operators import merge

START, END = month_window("2000-01-01", "%Y-%m-%d", months=12)
KEYS = ("ident", "month")


def month(column):
    return F.add_months(F.lit("2000-01-01").cast("date"), (F.col(column) % 6).cast("int"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def source(spark, name, n=2000):
    rows = spark.range(n).select(F.col("id").alias("raw"), month("id").alias("at"), (F.col("id") * 2).alias(name), F.lit("x").alias(f"{name}_text"))
    return merge.Source(rows, "raw", "at")


def test_half_of_the_rows_on_one_key(spark, no_broadcast):
    ident = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 5 == 0, None).otherwise(F.col("id"))
    frame = spark.range(6000).select("id", ident.alias("ident")).withColumn("month", month("ident"))
    sources = [source(spark, "a"), source(spark, "b")]
    hot = merge.hot_keys(frame, KEYS)
    assert len(hot) == 2
    found = merge.merge_windowed(frame, sources, KEYS, START, END)
    plain = frame
    for s in sources:
        plain = plain.join(s.table.withColumnsRenamed({"raw": "ident", "at": "month"}), list(KEYS), "left")
    assert found.columns == plain.columns and found.count() == 6000
    assert found.exceptAll(plain).isEmpty() and found.where("ident = 7 and a = 14").count() == 3001


def test_one_exchange_per_source(spark, no_broadcast):
    frame = spark.range(3000).select(F.col("id").alias("ident"), month("id").alias("month"))
    found = merge.merge_windowed(frame, [source(spark, "a"), source(spark, "b")], KEYS, START, END, keep=["a", "b_text"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan)) == 3
    assert found.columns == ["ident", "month", "a", "b_text"] and found.where("a = ident * 2").count() == 2000


def test_repeats_raise_when_read(spark):
    frame = spark.range(10).select(F.col("id").alias("ident"), month("id").alias("month"))
    one = source(spark, "a", 10)
    nulls = spark.createDataFrame([(None, None), (None, None)], "raw long, at date").select("raw", "at", F.lit(1).alias("a"), F.lit("y").alias("a_text"))
    with_nulls = merge.Source(one.table.select("raw", "at", "a", "a_text").union(nulls), "raw", "at")
    assert merge.merge_windowed(frame, [with_nulls], KEYS, START, END).count() == 10
    twice = merge.Source(one.table.union(one.table.where("raw = 3")), "raw", "at")
    found = merge.merge_windowed(frame, [twice], KEYS, START, END)
    # The check holds even if no column of the source is asked for.
    for read in (found, found.select("ident"), merge.merge_windowed(frame, [twice], KEYS, START, END, keep=[])):
        with pytest.raises(SparkRuntimeException, match='repeats.*"ident":3'):
            read.collect()
    assert merge.merge_windowed(frame.limit(0), [one], KEYS, START, END).count() == 0
