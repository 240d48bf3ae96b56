"""Left joins of feature tables onto a spine, and the outcome join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.lake import scan_window

# A key of a frame with one part in so many of its rows is hot; there are no more of them.
HOT_SHARE = 256


@dataclass(frozen=True)
class Source:
    """A raw feature table with its own key names."""

    table: DataFrame
    ident: str
    date: str


def join_features(spine: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spine ⟕ features; every spine row stays."""
    clash = (set(spine.columns) & set(features.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    return spine.join(features, list(keys), "left")


def merge_features(spine: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All tables on the spine. The fold joins on one key list, so the spine is
    shuffled once; tables bucketed by the keys are not shuffled at all."""
    return reduce(lambda left, right: join_features(left, right, keys), tables, spine)


def merge_cleaned(spine: DataFrame, tables: Sequence[DataFrame], spine_columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Cleaned tables each repeat the spine; only their own columns are added."""
    own = [t.drop(*[c for c in spine_columns if c not in keys]) for t in tables]
    return merge_features(spine, own, keys)


def once_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, which raise an error when they are read if a key occurs twice: a
    left join would repeat the rows of its frame. A key with a null never joins,
    so its rows are left out.

    The check needs the rows of a key together and in order, and so does the join
    that follows: both share one shuffle and one sort.
    """
    known = rows.dropna(subset=list(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(F.lit(f"a source repeats values of {list(keys)}: "), F.to_json(F.struct(*keys)))
    alone = F.when(F.col("_place") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return known.withColumn("_place", place).where(alone).drop("_place")


def hot_keys(frame: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold one part in ``share`` of the rows or more, so at
    most ``share`` of them.

    Every task counts its rows by a hash of the key in ``8 * share`` slots; only
    slots as full as a hot key would make them are looked at a second time.
    """
    slot = F.pmod(_key_hash(keys), F.lit(8 * share))
    counted = frame.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counted)
    full = [r["slot"] for r in counted if r["n"] * share >= total]
    if not full:
        return []
    each = frame.where(slot.isin(full)).groupBy(_key_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return [r["h"] for r in each.where(F.col("n") * share >= total).collect()]


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def merge_windowed(
    frame: DataFrame,
    sources: Sequence[Source],
    keys: tuple[str, str],
    start: date,
    end: date,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Raw sources cut to a date window, keys renamed, columns cut to ``keep``
    before the joins, left-joined onto ``frame``. Repeated source keys are an error
    when the result is read.

    One shuffle per source and one of the frame. Rows of the frame whose key holds
    a large share of them stay where they are: each source has one row at most for
    such a key, and the few of them are broadcast.
    """
    ident, period = keys
    tables = []
    for source in sources:
        rows = scan_window(source.table, source.date, start, end)
        own = [c for c in rows.columns if c not in (source.ident, source.date) and (keep is None or c in keep)]
        renamed = rows.select(F.col(source.ident).alias(ident), F.col(source.date).cast("date").alias(period), *own)
        tables.append(once_per_key(renamed, keys))
    hot = hot_keys(frame, keys)
    if not hot:
        return merge_features(frame, tables, keys)
    often = _key_hash(keys).isin(hot)
    rest = merge_features(frame.where(~often), tables, keys)
    return rest.unionByName(merge_features(frame.where(often), [F.broadcast(t.where(often)) for t in tables], keys))


def join_outcomes(scores: DataFrame, outcomes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Scores whose outcome is known."""
    return scores.join(outcomes, list(keys), "inner")
