"""Cleaning: which columns stay, how each is rewritten. The plan is fitted once
and replayed on production data."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import profile
from tidemark.options import Options

# The filler for missing text and the label alphabet.
MISSING_TEXT = "SIN_INFO"
SPACE = "_"
# All but a-z, A-Z, 0-9 and _. The shorthand is matched ten times as fast as the ranges.
OUTSIDE = r"[^\w]"


def trimmed(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> DataFrame:
    texts = profile.string_columns(df, exclude)
    return df.withColumns({c: F.trim(c) for c in texts}) if texts else df


def tidy(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Trimmed, upper-case string columns; booleans become 0 and 1."""
    tidied = {c: F.upper(F.trim(c)) for c in profile.string_columns(df, exclude)}
    tidied |= {f.name: F.col(f.name).cast("int") for f in df.schema if _boolean(f.dataType) and f.name not in exclude}
    return df.withColumns(tidied) if tidied else df


def _boolean(kind: T.DataType) -> bool:
    return isinstance(kind, T.BooleanType)


def safe_text(column: Column) -> Column:
    return F.regexp_replace(F.replace(column, F.lit(" "), F.lit(SPACE)), OUTSIDE, "")


def clean_strings(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> DataFrame:
    texts = profile.string_columns(df, exclude)
    return tidy(df, exclude).withColumns({c: safe_text(F.col(c)) for c in texts}) if texts else df


def encode_binary(column: Column, low, high) -> Column:
    """1 for the greater value, 0 for the other, null for null or unseen values."""
    return F.when(column == F.lit(high), 1).when(column == F.lit(low), 0)


def fill_nulls(df: DataFrame, exclude: list[str] | tuple[str, ...] = (), bin_input: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """0 for numbers; the filler text for strings and for ``bin_input`` columns,
    which become text."""
    numbers = [c for c in profile.numeric_columns(df, exclude) if c not in bin_input]
    texts = profile.string_columns(df, exclude)
    flagged = [c for c in bin_input if c in df.columns and c not in exclude]
    filled = {c: F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)) for c in numbers}
    filled |= {c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT)) for c in (*texts, *flagged)}
    return df.withColumns(filled) if filled else df


@dataclass(frozen=True)
class CleanPlan:
    spine: tuple[str, ...]
    columns: tuple[str, ...]
    dropped: dict[str, str] = field(default_factory=dict)
    binary: dict[str, tuple] = field(default_factory=dict)
    plain_binary: tuple[str, ...] = ()
    bin_input: tuple[str, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        passed = [c for c in self.spine if c in df.columns]
        tidied = tidy(df.select(*passed, *self.columns), self.spine)
        encoded = {c: encode_binary(F.col(c), low, high) for c, (low, high) in self.binary.items()}
        df = tidied.withColumns(encoded) if encoded else tidied
        texts = profile.string_columns(df, self.spine)
        df = df.withColumns({c: safe_text(F.col(c)) for c in texts}) if texts else df
        return fill_nulls(df, self.spine, self.bin_input)

    def only(self, columns: list[str]) -> CleanPlan:
        """The plan restricted to some source columns."""
        keep = [c for c in self.columns if c in columns]
        return CleanPlan(
            self.spine,
            tuple(keep),
            self.dropped,
            {c: v for c, v in self.binary.items() if c in keep},
            tuple(c for c in self.plain_binary if c in keep),
            self.bin_input,
        )

    def to_json(self) -> str:
        return json.dumps(
            {
                "spine": self.spine,
                "columns": self.columns,
                "dropped": self.dropped,
                "binary": {c: [_to_text(low), _to_text(high)] for c, (low, high) in self.binary.items()},
                "plain_binary": self.plain_binary,
                "bin_input": self.bin_input,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> CleanPlan:
        saved = json.loads(text)
        return cls(
            tuple(saved["spine"]),
            tuple(saved["columns"]),
            saved["dropped"],
            {c: (_from_text(low), _from_text(high)) for c, (low, high) in saved["binary"].items()},
            tuple(saved["plain_binary"]),
            tuple(saved["bin_input"]),
        )


def _to_text(value) -> list[str]:
    return [type(value).__name__, str(value)]


def _from_text(saved: list[str]):
    kind, text = saved
    return {"str": str, "int": int, "float": float, "Decimal": Decimal}[kind](text)


def fit_clean(df: DataFrame, options: Options, drop: bool = True, low_variance: bool = False) -> CleanPlan:
    """Two column-pruned passes over ``df``. With ``drop=False`` no column is
    dropped by its statistics (the refit before production)."""
    spine = [c for c in options.spine.all() if c in df.columns]
    base = tidy(df.drop(*options.feat_drop), spine)
    if options.fit_on == "train":
        base = base.where(F.col(options.spine.ind_split) == "train")
    columns = [c for c in base.columns if c not in spine]
    profiled = [f.name for f in base.schema if f.name in columns and _profiled(f.dataType)]
    first = profile.first_look(base, profiled, options.step_size, variance=low_variance)
    dropped: dict[str, str] = {}
    if drop:
        dropped |= {c: "nulls" for c in profile.null_heavy(first, options.null_threshold)}
    rest = [c for c in profiled if c not in dropped]
    second = profile.second_look(base, rest, first, options.step_size)
    if drop:
        if options.null_threshold < profile.DOMINANT_FROM:
            heavy = profile.heavy_values(base, rest, options.null_threshold, options.step_size) if rest else None
            constant = sorted({r["column"] for r in heavy.collect()}) if heavy is not None else []
        else:
            constant = profile.quasi_constant(second, options.null_threshold)
        dropped |= {c: "constant" for c in constant}
    if low_variance and options.varc_threshold is not None:
        flat = profile.low_variance(first, options.varc_threshold, options.population)
        dropped |= {c: "variance" for c in flat if c not in dropped}
    dates = {f.name for f in base.schema if isinstance(f.dataType, _DATES)}
    pairs = {c: v for c, v in profile.binary_values(first, second).items() if c not in dropped and c not in dates}
    return CleanPlan(
        spine=tuple(options.spine.all()),
        columns=tuple(c for c in columns if c not in dropped),
        dropped=dropped,
        binary={c: v for c, v in pairs.items() if profile.needs_encoding(*v)},
        plain_binary=tuple(c for c, v in pairs.items() if not profile.needs_encoding(*v)),
        bin_input=options.bin_input,
    )


# Dates and times may be dropped for nulls or one value, and are never filled or encoded.
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _profiled(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, *_DATES))
