"""Column profiles. Each pass aggregates map-side and returns one small row per
column; columns go in batches to bound the size of one aggregate."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A median sketch of this accuracy hits any value above this share of the non-null rows.
MEDIAN_ACCURACY = 1000
DOMINANT_FROM = 0.51


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def batches(columns: list[str], step: int) -> Iterator[list[str]]:
    for start in range(0, len(columns), step):
        yield columns[start : start + step]


def per_column(df: DataFrame, columns: list[str], value: str, measure: Callable[[str], Column], step: int) -> DataFrame:
    """One aggregate over many columns, turned into rows (column, ``value``)."""
    parts = []
    for batch in batches(columns, step):
        wide = df.agg(*[measure(c).alias(c) for c in batch])
        parts.append(wide.unpivot([], batch, "column", value))
    return reduce(DataFrame.unionByName, parts)


def long_form(df: DataFrame, keep: list[str], columns: list[str], name: str, value: str, step: int = 200) -> DataFrame:
    """Rows (keep, name, value) of equally typed columns. Each batch is a scan
    of its own columns, so no single expand lists thousands of them."""
    parts = [df.select(*keep, *batch).unpivot(keep, batch, name, value) for batch in batches(columns, step)]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, columns: list[str], step: int = 200) -> DataFrame:
    return per_column(df, columns, "null_share", lambda c: F.avg(F.col(c).isNull().cast("double")), step)


def sketch_size(rsd: float) -> int:
    """The logarithm of the registers that a sketch of this relative error needs."""
    size = max(4, math.ceil(math.log2((1.04 / rsd) ** 2)))
    if size > 21:
        raise ValueError(f"rsd {rsd} is finer than a sketch can be")
    return size


def distinct_profile(df: DataFrame, columns: list[str], rsd: float = 0.015, step: int = 200) -> DataFrame:
    """Approximate distinct counts by mergeable sketches; no shuffle of values.

    One binary sketch per column: ``approx_count_distinct`` at this error would
    add hundreds of buffer columns each, which a wide table cannot plan.
    """
    size = sketch_size(rsd)

    def measure(c: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(_hashed(c), size)), F.lit(0))

    return per_column(df, columns, "n_distinct", measure, step)


def _hashed(column: str) -> Column:
    """52 hash bits of a value, exact as a double; null for null."""
    return F.when(F.col(column).isNotNull(), F.shiftrightunsigned(F.xxhash64(column), 12))


def variance_profile(df: DataFrame, columns: list[str], population: bool = False, step: int = 200) -> DataFrame:
    variance = F.var_pop if population else F.var_samp
    return per_column(df, columns, "variance", lambda c: variance(F.col(c).cast("double")), step)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) with values as text. Expand and partial count run in
    the scan stage; one shuffle moves a row per distinct value and task."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return long_form(texts, [], columns, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def mode_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct count and share of the most frequent non-null value in all rows."""
    seen = F.col("value").isNotNull()
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(
            F.count_if(seen).alias("n_distinct"),
            (F.coalesce(F.max(F.when(seen, F.col("n"))), F.lit(0)) / F.sum("n")).alias("mode_share"),
        )
    )


def heavy_values(df: DataFrame, columns: list[str], share: float, step: int = 200) -> DataFrame:
    """(column, value, n, share) of every non-null value that more than ``share`` of
    all rows hold, values as text.

    Values are first counted by ten bits of their hash, then, in slots that are
    full enough to hold such a value, by ten more, and only then by themselves. No
    pass shuffles more than a thousand counts per column, task and full slot, and
    columns without a full slot are not read again.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counted = texts.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    full: dict[str, list[int] | None] = dict.fromkeys(columns)
    for bits in (_SLOT_BITS, 2 * _SLOT_BITS):
        slots = _in_slots(texts, full, bits - _SLOT_BITS, step).groupBy("column", _slot("value", bits).alias("slot"))
        found: dict[str, list[int]] = {}
        for row in slots.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share * counted).collect():
            found.setdefault(row["column"], []).append(row["slot"])
        full = found
    if not full:
        return df.sparkSession.createDataFrame([], "column string, value string, n long, share double")
    values = _in_slots(texts, full, 2 * _SLOT_BITS, step).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.where(F.col("n") > share * counted).withColumn("share", F.col("n") / counted)


_SLOT_BITS = 10


def _slot(column: str, bits: int) -> Column:
    return F.xxhash64(F.col(column)).bitwiseAND(F.lit((1 << bits) - 1))


def _in_slots(texts: DataFrame, slots: dict[str, list[int] | None], bits: int, step: int) -> DataFrame:
    """(column, value) of the non-null values in the listed slots, all if there is no list."""
    kept = [
        F.col(c) if some is None else F.when(_slot(c, bits).isin(some), F.col(c)).alias(c) for c, some in slots.items()
    ]
    names = list(slots)
    long = long_form(texts.select(*kept), [], names, "column", "value", step) if names else texts.sparkSession.createDataFrame([], "column string, value string")
    return long.where(F.col("value").isNotNull())


def first_look(df: DataFrame, columns: list[str], step: int, variance: bool = False) -> dict[str, dict]:
    """Per column: null share, smallest and greatest value, the hash of the
    only value that could hold a majority, and on request variances of numbers."""
    numbers = set(numeric_columns(df)) if variance else set()
    found: dict[str, dict] = {}
    for batch in batches(columns, step):
        row = df.agg(
            *[
                F.struct(
                    F.avg(F.col(c).isNull().cast("double")).alias("nulls"),
                    F.min(c).alias("low"),
                    F.max(c).alias("high"),
                    (F.var_samp(F.col(c).cast("double")) if c in numbers else F.lit(None).cast("double")).alias("var_samp"),
                    (F.var_pop(F.col(c).cast("double")) if c in numbers else F.lit(None).cast("double")).alias("var_pop"),
                    F.percentile_approx(_hashed(c), 0.5, MEDIAN_ACCURACY).alias("middle"),
                ).alias(c)
                for c in batch
            ]
        ).first()
        found.update({c: row[c].asDict() for c in batch})
    return found


def second_look(df: DataFrame, columns: list[str], first: dict[str, dict], step: int) -> dict[str, dict]:
    """Per column: exact share of the candidate value, and the number of rows
    that are neither the smallest nor the greatest value."""
    found: dict[str, dict] = {}
    for batch in batches([c for c in columns if first[c]["middle"] is not None], step):
        row = df.agg(
            *[
                F.struct(
                    F.avg(F.coalesce(_hashed(c) == first[c]["middle"], F.lit(False)).cast("double")).alias("share"),
                    F.count_if((F.col(c) != F.lit(first[c]["low"])) & (F.col(c) != F.lit(first[c]["high"]))).alias("between"),
                ).alias(c)
                for c in batch
            ]
        ).first()
        found.update({c: row[c].asDict() for c in batch})
    return found


def binary_values(first: dict[str, dict], second: dict[str, dict]) -> dict[str, tuple]:
    """(low, high) of the columns with exactly two distinct non-null values."""
    return {
        c: (first[c]["low"], first[c]["high"])
        for c, seen in second.items()
        if seen["between"] == 0 and first[c]["low"] != first[c]["high"]
    }


def binary_profile(df: DataFrame, columns: list[str], step: int = 200) -> DataFrame:
    """(column, low, high, needs_encoding) of the binary columns, values as text."""
    first = first_look(df, columns, step)
    pairs = binary_values(first, second_look(df, columns, first, step))
    rows = [(c, str(low), str(high), needs_encoding(low, high)) for c, (low, high) in pairs.items()]
    return df.sparkSession.createDataFrame(rows, "column string, low string, high string, needs_encoding boolean")


def needs_encoding(low, high) -> bool:
    return isinstance(low, str) or (low, high) != (0, 1)


def null_heavy(first: dict[str, dict], threshold: float) -> list[str]:
    return [c for c, seen in first.items() if seen["nulls"] > threshold]


def quasi_constant(second: dict[str, dict], threshold: float) -> list[str]:
    return [c for c, seen in second.items() if seen["share"] > threshold]


def low_variance(first: dict[str, dict], threshold: float, population: bool = False) -> list[str]:
    kind = "var_pop" if population else "var_samp"
    return [c for c, seen in first.items() if seen[kind] is not None and seen[kind] < threshold]
