"""Catalog tables, CSV reports, JSON feature lists and fitted objects."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = r"_\d{8}_\d{6}"
# The partition of one try of a run.
RUN_PART = "run_part"


def scan_window(table: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Rows dated between two days, both included. Bounds take the type of the
    column, so the filter prunes partitions or reaches the Parquet scan."""
    kind = table.schema[column].dataType
    if isinstance(kind, T.StringType):
        low, high = F.lit(start.isoformat()), F.lit(end.isoformat())
        return table.where(F.col(column).between(low, high))
    if isinstance(kind, T.DateType):
        return table.where(F.col(column).between(F.lit(start), F.lit(end)))
    low, after = F.lit(start).cast(kind), F.lit(date.fromordinal(end.toordinal() + 1)).cast(kind)
    return table.where((F.col(column) >= low) & (F.col(column) < after))


def latest_version(spark: SparkSession, schema: str, base: str) -> str:
    """Newest ``{base}_yyyyMMdd_HHmmss`` table of a schema."""
    named = re.compile(re.escape(base) + VERSION)
    names = [t.name for t in spark.catalog.listTables(schema, f"{base}_*") if named.fullmatch(t.name)]
    if not names:
        raise LookupError(f"no version of {base} in {schema}")
    return max(names)


def read_latest(spark: SparkSession, schema: str, base: str) -> DataFrame:
    return spark.read.table(f"{schema}.{latest_version(spark, schema, base)}")


def latest_slice(table: DataFrame, period: str, stamp: str = "exec_time", per_date: bool = False) -> DataFrame:
    """Rows of the last period and the last run. The two maxima are independent,
    so a late run of an older period leaves nothing; ``per_date`` takes the last
    run of the last period instead."""
    if not per_date:
        last_period = table.select(F.max(period)).scalar()
        last_stamp = table.select(F.max(stamp)).scalar()
        return table.where((F.col(period) == last_period) & (F.col(stamp) == last_stamp))
    last = table.select(F.max(F.struct(period, stamp))).scalar()
    return table.where((F.col(period) == last[period]) & (F.col(stamp) == last[stamp]))


def partitions(spark: SparkSession, name: str) -> DataFrame | None:
    """The partition values of a catalog table in the types of their columns, a
    row per partition as the catalog lists them, without a look at any file. Null
    for a table without partitions."""
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not by:
        return None
    fields = spark.table(name).schema
    listed = spark.sql(f"SHOW PARTITIONS {name}").select(F.split("partition", "/").alias("spec"))
    columns = []
    for i, c in enumerate(by):
        # The catalog escapes bytes as %XX and leaves a plus sign alone.
        value = F.substring_index(F.get("spec", F.lit(i)), "=", -1)
        value = F.when(value != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))))
        columns.append(value.cast(fields[c].dataType).alias(c))
    return listed.select(*columns)


def last_slice(spark: SparkSession, name: str, period: str, stamp: str = "exec_time", per_date: bool = False) -> DataFrame:
    """``latest_slice`` of a catalog table; of a table that keeps runs, finished ones alone.

    Maxima of partition columns are read off the catalog, so that the scan opens
    the partitions of the answer only. Where the period alone is one, ``per_date``
    looks for the last stamp within its last partition. Other layouts, and tables
    whose last partition is listed but empty, take their maxima from the rows.
    """
    runs = RUN_PART in spark.table(name).columns
    table = committed_rows(spark, name) if runs else spark.table(name)
    listed = partitions(spark, name)
    if listed is None or period not in listed.columns or not (per_date or stamp in listed.columns):
        return latest_slice(table, period, stamp, per_date)
    if runs:
        listed = listed.where(F.col(RUN_PART).isin(list(committed_runs(spark, name).values())))
    if stamp in listed.columns:
        last = F.struct(period, stamp) if per_date else F.struct(F.max(period).alias(period), F.max(stamp).alias(stamp))
        ends = listed.agg((F.max(last) if per_date else last).alias("last")).select("last.*")
    else:
        ends = listed.agg(F.max(period).alias(period))
    kinds = dict(ends.dtypes)
    found = ends.select(*[F.col(c).cast("string") for c in ends.columns]).first().asDict()
    kept = table.where(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v).cast(kinds[c]) for c, v in found.items()]))
    if kept.isEmpty():
        return latest_slice(table, period, stamp, per_date)
    return kept if stamp in found else latest_slice(kept, period, stamp, per_date=True)


def save_versioned(
    df: DataFrame,
    schema: str,
    base: str,
    stamp: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> str:
    """Saves a new version and returns its full name. Tables bucketed alike by
    the join keys are later joined without a shuffle."""
    name = f"{schema}.{base}_{stamp}"
    if bucket_by:
        count, columns = bucket_by
        df = df.repartition(count, *columns)
    elif partition_by:
        # Few files per partition, and hot partitions split by adaptive execution.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    writer.saveAsTable(name)
    return name


def append_or_create(df: DataFrame, name: str, partition_by: Sequence[str] = (), replace: bool = False) -> None:
    """Appends to a table or creates it. ``replace`` overwrites exactly the
    partitions present in ``df``, which makes a rerun harmless."""
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if not spark.catalog.tableExists(name):
        writer = df.write.format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return
    known = spark.table(name).columns
    extra = [c for c in df.columns if c not in known]
    if extra:
        raise ValueError(f"columns that {name} lacks: {extra}")
    rows = df.select(*known)
    if not replace:
        rows.write.insertInto(name)
        return
    # Only the session setting reaches an insert into a catalog table.
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def append_run(df: DataFrame, name: str, run: str, partition_by: Sequence[str] = ()) -> bool:
    """Appends the rows of ``run`` once, however often the job is tried.

    Every attempt writes to a partition of its own, and its rows count only when
    table ``{name}_runs`` names that partition, by one small append at the end. A
    job that died before leaves rows that nothing reads; one that is run again
    after its end writes nothing and gives False. Of two attempts that end at the
    same time the first one named counts.
    """
    spark = df.sparkSession
    if run in committed_runs(spark, name):
        return False
    part = f"{run}-{uuid.uuid4().hex[:12]}"
    append_or_create(df.withColumn(RUN_PART, F.lit(part)), name, [*partition_by, RUN_PART])
    _name_run(spark, name, run, part)
    return True


def _name_run(spark: SparkSession, name: str, run: str, part: str) -> None:
    named = spark.range(1, numPartitions=1).select(F.lit(run).alias("run"), F.lit(part).alias("part"), F.current_timestamp().alias("named"))
    append_or_create(named, f"{name}_runs")


def committed_runs(spark: SparkSession, name: str) -> dict[str, str]:
    """Run to partition, one row per run."""
    if not spark.catalog.tableExists(f"{name}_runs"):
        return {}
    first = spark.table(f"{name}_runs").groupBy("run").agg(F.min(F.struct("named", "part")).alias("first"))
    return {r["run"]: r["part"] for r in first.select("run", "first.part").collect()}


def committed_rows(spark: SparkSession, name: str) -> DataFrame:
    """The rows of finished runs; other partitions are not read."""
    parts = list(committed_runs(spark, name).values())
    return spark.table(name).where(F.col(RUN_PART).isin(parts)).drop(RUN_PART)


def sweep_runs(spark: SparkSession, name: str) -> int:
    """Drops the partitions of attempts that no run names, and gives their number.
    Not to be called while a job writes to the table."""
    named = list(committed_runs(spark, name).values())
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    left = spark.table(name).where(~F.col(RUN_PART).isin(named)).select(*[F.col(c).cast("string") for c in by]).distinct().collect()
    for row in left:
        values = ", ".join(f"{c} = null" if row[c] is None else f"{c} = '{row[c]}'" for c in by)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({values})")
    return len(left)


def drop_if_written(spark: SparkSession, written: str, tables: Sequence[str]) -> bool:
    """Drops intermediate tables once the output has rows."""
    if spark.read.table(written).isEmpty():
        return False
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return True


def save_report(df: DataFrame, path: str) -> None:
    """A report as one CSV file with header; reports hold a few rows per
    feature, bucket or period."""
    df.repartition(1).write.mode("overwrite").csv(path, header=True)


def save_large_report(df: DataFrame, path: str) -> None:
    """A report with a row per period, variable and value: as many CSV files as its size asks for."""
    df.hint("rebalance").write.mode("overwrite").csv(path, header=True)


def read_report(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_if_present(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A report that may not have been written; other failures still raise."""
    try:
        return read_report(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def save_features(spark: SparkSession, features: Sequence[str], path: str) -> None:
    """The chosen model features, in model order, as one JSON object."""
    chosen = spark.createDataFrame([(list(features),)], "chosen_feat array<string>")
    chosen.coalesce(1).write.mode("overwrite").json(path)


def read_features(spark: SparkSession, path: str) -> list[str]:
    return spark.read.schema("chosen_feat array<string>").json(path).first()["chosen_feat"]


def save_text(spark: SparkSession, text: str, path: str) -> None:
    """A fitted plan's JSON."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"].rstrip("\n")


def save_fitted(fitted, path: str) -> None:
    fitted.write().overwrite().save(path)


def load_fitted(kind, path: str):
    return kind.load(path)
