"""Wide rows are written by methods that are compiled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sources import staging


def test_limit_holds_while_rows_are_staged(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    with staging.short_methods(spark):
        assert spark.conf.get(limit) == "8000"
    assert spark.conf.get(limit) == before
    with pytest.raises(Exception, match="no such row"):
        staging.stage(spark.range(3).select(F.raise_error(F.lit("no such row")).cast("int").alias("x")))
    assert spark.conf.get(limit) == before
    flags = [(F.col("id") % 300 == i).cast("int").alias(f"f{i}") for i in range(300)]
    wide = staging.stage(spark.range(600).select("id", *flags))
    assert wide.count() == 600 and wide.agg(F.sum("f7"), F.sum("f299")).first() == (2, 2)
