"""Rows are cleaned once, by the label alphabet."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.clean import safe_text
from workloads import lake


def test_rows_are_cleaned_once(spark, sf_dir, monkeypatch):
    seen = []
    plain = lake.fit_encode
    monkeypatch.setattr(lake, "fit_encode", lambda train, columns: seen.append(train) or plain(train, columns))
    _, rows, _, _ = lake._fitted(spark, sf_dir)
    for frame in (*seen, rows):
        assert "regexp_replace" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_label_alphabet(spark):
    odd = [None, "", " ", "a b-c_D9", "Été 1", "١xK", "\U0001d7d8y", "tab\tnl\n.", "µm  z"]
    found = spark.createDataFrame([(x,) for x in odd], "x string").select(safe_text(F.col("x")).alias("y")).collect()
    assert [r["y"] for r in found] == [None, "", "_", "a_bc_D9", "t_1", "x", "y", "tabnl", "m_z"]
