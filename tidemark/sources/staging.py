"""Staged tables and small fitted frames.

``stage`` cuts lineage by a Parquet write into the shared folder the session
names in ``spark.checkpoint.dir``; it survives the loss of any executor, and
later reads are column-pruned. ``pinned`` stages an aggregate, whose exact size
the planner then knows, whatever that size is.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A temporary one is made only for a
    local master with the setting unset."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="tidemark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, grouped by application."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Deletes what this application staged; frames built on it cannot be read afterwards."""
    java = spark.sparkContext._jvm
    path = java.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Bytes of a method above which the virtual machine interprets it and never compiles it.
_LONGEST_METHOD = "8000"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """While it is open, plans of many columns run operator by operator, each in
    methods that are compiled, and not as one method that is too long for that."""
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, min(before, _LONGEST_METHOD, key=int))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    with short_methods(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """A small aggregate computed once. The planner reads its size off the
    files and broadcasts it only below the session's threshold."""
    return stage(df, "pinned")
