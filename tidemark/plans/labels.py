"""Labels of text columns as a table: indexing, one-hot and sparse features for
columns of any number of labels.

A column's labels are ranked by frequency and never leave the cluster: the table
holds (value, idx, n), stored by column. An index is found by two joins. The
``HOT`` most frequent labels are few, so they are broadcast and met where the rows
lie. Every rarer label has less than one row in ``HOT``, as each of the ``HOT``
before it has no fewer, so the shuffle for the rest knows no hot key; rows that
need no second look-up are spread over keys that match nothing.

Vectors are built as (size, indices, values) by column expressions. They carry no
list of names, which a million labels would put on the driver; ``names`` gives
that list as a table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordering import ranked
from tidemark.operators.profile import value_counts
from tidemark.sources.staging import fresh_path, stage

# The labels of a column that may be broadcast.
HOT = 4096
# Bytes of them; beyond that the planner chooses the join by their size.
HOT_BYTES = 8 << 20
_ROWS = "value string, idx int, n long, column string"
_VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


@dataclass(frozen=True)
class LabelTable:
    """Labels per column in ``folder``, their numbers, and the bytes of the hot ones."""

    spark: SparkSession
    folder: str
    sizes: dict[str, int]
    bytes: dict[str, int]

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> LabelTable:
        hot = F.when(F.col("idx") < HOT, F.octet_length("value"))
        counted = _read(spark, folder).groupBy("column").agg(F.count("value"), F.coalesce(F.sum(hot), F.lit(0))).collect()
        return cls(spark, folder, {c: n for c, n, _ in counted}, {c: n for c, _, n in counted})

    def save(self, folder: str) -> None:
        rows = _read(self.spark, self.folder) if self.sizes else self.spark.createDataFrame([], _ROWS)
        _write(rows.where(F.col("column").isin(list(self.sizes))), folder, "overwrite")

    def only(self, columns: list[str]) -> LabelTable:
        sizes = {c: n for c, n in self.sizes.items() if c in columns}
        return LabelTable(self.spark, self.folder, sizes, {c: self.bytes[c] for c in sizes})

    def labels(self, column: str) -> DataFrame:
        """(value, idx, n) of one column, in no order."""
        found = _read(self.spark, self.folder).where(F.col("column") == column)
        return found.where(F.col("value").isNotNull()).drop("column")

    def index(self, df: DataFrame, suffix: str = "_idx") -> DataFrame:
        """Adds the index of each column, from 0 by frequency, ties in label order;
        null and unseen labels get the last index."""
        return reduce(lambda rows, c: self._indexed(rows, c, c + suffix), self.sizes, df)

    def _indexed(self, df: DataFrame, column: str, name: str) -> DataFrame:
        known = self.labels(column).select(F.col("value").alias("_label"), F.col("idx").alias("_found"))
        hot = known.where(F.col("_found") < HOT)
        if self.bytes[column] <= HOT_BYTES:
            hot = F.broadcast(hot)
        rows = df.join(hot, F.col(column).cast("string") == F.col("_label"), "left").drop("_label")
        if self.sizes[column] > HOT:
            plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
            spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(HOT)).cast("string"))
            rest = F.col("_found").isNull() & F.col(column).isNotNull()
            rows = rows.withColumnRenamed("_found", "_first").withColumn(
                "_key", F.when(F.col("_first").isNull() & F.col(column).isNotNull(), F.col(column).cast("string")).otherwise(spread)
            )
            tail = known.where(F.col("_found") >= HOT)
            rows = rows.join(tail, F.col("_key") == F.col("_label"), "left").drop("_key", "_label")
            rows = rows.withColumn("_found", F.coalesce("_first", "_found")).drop("_first")
        last = F.lit(self.sizes[column])
        return rows.withColumn(name, F.coalesce("_found", last).cast("int")).drop("_found")

    def one_hot(self, df: DataFrame, suffix: str = "_ohe") -> DataFrame:
        """Adds a sparse vector per column, with a place for each label and one for
        null or unseen labels. Staged."""
        indexed = self.index(df, "_place")
        hot = {
            f"{c}{suffix}": _sparse(F.lit(n + 1), F.array(_cell(F.col(f"{c}_place"), F.lit(1.0))))
            for c, n in self.sizes.items()
        }
        return _as_vectors(indexed.withColumns(hot).drop(*[f"{c}_place" for c in self.sizes]), list(hot))

    def features(self, df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
        """Adds one sparse vector of ``columns``: numbers as they are, in the given
        order, then a place per label of each text column. Staged."""
        numbers = [c for c in columns if c not in self.sizes]
        texts = self.only(columns)
        cells = [_cell(F.lit(i), F.col(f"`{c}`").cast("double")) for i, c in enumerate(numbers)]
        for c, start in texts._starts(len(numbers)).items():
            place = F.col(f"{c}_place")
            cells.append(_cell(F.when(place < texts.sizes[c], place + start), F.lit(1.0)))
        size = len(numbers) + sum(texts.sizes.values())
        indexed = texts.index(df, "_place").withColumn(output, _sparse(F.lit(size), F.array(*cells)))
        return _as_vectors(indexed.drop(*[f"{c}_place" for c in texts.sizes]), [output])

    def names(self, columns: list[str]) -> DataFrame:
        """(position, feature, source) of the vector that ``features`` makes."""
        numbers = [c for c in columns if c not in self.sizes]
        texts = self.only(columns)
        found = self.spark.createDataFrame(
            [(i, c, c) for i, c in enumerate(numbers)], "position int, feature string, source string"
        )
        for c, start in texts._starts(len(numbers)).items():
            feature = F.concat(F.lit(f"{c}_"), F.col("value"))
            found = found.union(self.labels(c).select((F.col("idx") + start).cast("int"), feature, F.lit(c)))
        return found

    def _starts(self, first: int) -> dict[str, int]:
        starts = {}
        for c, n in self.sizes.items():
            starts[c], first = first, first + n
        return starts


def fit_labels(train: DataFrame, columns: list[str]) -> LabelTable:
    """Ranks the labels of ``columns`` by frequency, ties in label order."""
    return rank_labels(stage(value_counts(train, columns), "counts"), columns) if columns else none(train.sparkSession)


def rank_labels(counts: DataFrame, columns: list[str]) -> LabelTable:
    """The same from staged counts (column, value, n)."""
    spark, folder = counts.sparkSession, fresh_path(counts.sparkSession, "labels")
    known = counts.where(F.col("value").isNotNull() & F.col("column").isin(columns))
    placed = ranked(known, [F.col("n").desc(), F.col("value").asc()], ["column"], "_rank")
    rows = placed.select("column", "value", (F.col("_rank") - 1).cast("int").alias("idx"), "n")
    # A row without value lists each column, with labels or not.
    listed = spark.createDataFrame([(c, None, None, None) for c in columns], "column string, value string, idx int, n long")
    _write(rows.unionByName(listed), folder)
    return LabelTable.load(spark, folder).only(columns)


def none(spark: SparkSession) -> LabelTable:
    return LabelTable(spark, "", {}, {})


def merged(tables: list[LabelTable]) -> LabelTable:
    """One table of several; no column may be in two."""
    tables = [t for t in tables if t.sizes] or tables[:1]
    if len(tables) == 1:
        return tables[0]
    spark, folder = tables[0].spark, fresh_path(tables[0].spark, "labels")
    names = [c for t in tables for c in t.sizes]
    if len(set(names)) < len(names):
        raise ValueError(f"columns in two label tables: {sorted({c for c in names if names.count(c) > 1})}")
    parts = [_read(spark, t.folder).where(F.col("column").isin(list(t.sizes))) for t in tables]
    _write(reduce(DataFrame.unionByName, parts), folder)
    return LabelTable.load(spark, folder)


def _write(rows: DataFrame, folder: str, mode: str = "error") -> None:
    rows.hint("rebalance", "column").write.mode(mode).partitionBy("column").parquet(folder)


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_ROWS).parquet(folder)


def _cell(place: Column, value: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), value.alias("value"))


def _sparse(size: Column, cells: Column) -> Column:
    """The stored form of a sparse vector; cells come in order of their places.
    A null number is not a number, as an assembled vector keeps it."""
    there = F.filter(cells, lambda x: x["place"].isNotNull() & ((x["value"] != 0) | x["value"].isNull()))
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        size.cast("int").alias("size"),
        F.transform(there, lambda x: x["place"]).alias("indices"),
        F.transform(there, lambda x: F.coalesce(x["value"], F.lit(float("nan")))).alias("values"),
    ).cast(_VECTOR)


def _as_vectors(df: DataFrame, columns: list[str]) -> DataFrame:
    """The struct is what a vector is in Parquet, so the staged rows are read as vectors."""
    path = fresh_path(df.sparkSession, "vectors")
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name in columns else f.dataType) for f in df.schema]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
