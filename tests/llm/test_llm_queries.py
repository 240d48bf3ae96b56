"""Registered queries against their SQL twins, and the pipeline's stages."""

from __future__ import annotations

import check_oracle
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    duck = check_oracle.connection(sf_dir)
    assert check_oracle.compare(QUERIES[name](spark, sf_dir).toArrow(), duck.sql(ORACLE[name]).to_arrow_table()) == ""


def test_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, sf_dir).columns == docs.columns, name
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert out and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in out)


CLASH = ["kept", "score", "n_words", "n_bytes", "n_removed", "_doc", "_gone", "_size", "taken", "target", "shard", "tie", "own0", "a.b"]


def test_stages_pass_columns_of_any_name(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    more = docs.select("*", *[F.lit(c).alias(c) for c in CLASH])
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, more, sf_dir)
        assert out.columns == more.columns, name
        rows = out.collect()
        assert rows and all(r[c] == c for r in rows for c in CLASH), name
        assert len(rows) == step(spark, docs, sf_dir).count(), name
        assert all(r["n_chars"] == len(r["text"]) for r in rows), name
    assert corpus_pipeline.encoded(spark, more, sf_dir).count() == 120


def test_stages_take_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", "s", 0), (5, "", "en", "s", 0)], docs.schema)
    for step in (s for _, s in corpus_pipeline.STAGES):
        assert step(spark, docs.union(odd), sf_dir).count() > 0
        assert step(spark, docs.limit(0), sf_dir).count() == 0
