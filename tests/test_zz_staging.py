"""Last, because it removes what the session staged."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.sources.staging import clear_staged, fresh_path, shared_folder, stage


def test_stage_cuts_lineage_and_is_cleared(spark):
    rows = stage(spark.range(10).withColumnRenamed("id", "k"), "probe")
    assert rows.count() == 10 and "Range" not in rows._jdf.queryExecution().optimizedPlan().toString()
    folder = Path(fresh_path(spark, "x")).parent
    assert folder.parent == Path(shared_folder(spark)) and folder.exists()
    assert spark.conf.get("spark.checkpoint.dir") == shared_folder(spark)
    clear_staged(spark)
    assert not folder.exists() and folder.parent.exists()


def test_command_line(spark, sf_dir, tmp_path):
    from workloads.fixtures import spine_cm

    spark.sql(f"CREATE DATABASE cli LOCATION '{tmp_path}/lake'")
    rows = spine_cm(spark, sf_dir).select(F.col("ident").alias("cliident"), F.col("month").alias("date_part"), "target")
    rows.write.saveAsTable("cli.people")
    config = {
        "schema": "cli", "folder": f"{tmp_path}/out", "ini_date": ["200001", "%Y%m"], "qty_months": 11, "buckets": 4,
        "table_sources": {"spine": "cli.people"}, "table_outputs": {"spine": "cli_spine"}, "conf": {"train_size": 0.5},
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config))
    jobs.main(["spine", "-c", str(path)])
    names = [t.name for t in spark.catalog.listTables("cli") if t.name.startswith("cli_spine_")]
    saved = spark.read.table(f"cli.{names[0]}")
    assert saved.count() == rows.where("date_part between '2000-01-01' and '2000-12-31'").count()
    assert saved.where("ind_split = 'val'").select("data_date_part").distinct().count() == 1
    with pytest.raises(SystemExit):
        jobs.main(["clean", "-c", str(path)])
