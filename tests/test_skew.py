"""The split join gives the rows of a plain join, and shuffles no rows of hot keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.skew import split_join


def test_split_join_equals_plain_join(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).when(F.col("id") % 50 == 0, None).otherwise(F.col("id")).alias("k"), "id"
    )
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("k is null or k % 2 = 1")
    plain = rows.join(facts.drop("n"), ["k"])
    for most in (1, 16, 4096):
        found = split_join(rows, facts, ["k"], "n", most)
        assert found.columns == plain.columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert split_join(rows, facts.limit(0), ["k"], "n").count() == 0
    assert split_join(rows.limit(0), facts, ["k"], "n").count() == 0
