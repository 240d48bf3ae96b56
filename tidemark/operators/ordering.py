"""Ranks, running totals and exact quantiles over whole groups.

A window without partitions, or partitioned by a column of which one value
holds a third of the rows, sorts that share in one task. Here the rows are
range-partitioned by (groups, order) instead, which splits a group as often as
its size asks for, and staged once. Each range then only needs the totals of
the ranges before it: one small row per (range, group). Range partitioning
samples its input first, so an input that is costly to compute and does not
end in a shuffle should be staged by the caller.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.profile import batches, long_form
from tidemark.sources.staging import pinned, stage

_AT = "_at"
_RANGE = "_range"
# monotonically_increasing_id keeps the partition number above 33 bits.
_ROW_BITS = 33
# Sketches that one aggregate holds at a time; each is below 1 MB.
_SKETCHES = 512
# A group key for rows without groups.
_WHOLE = "_whole"


def ranked(
    df: DataFrame,
    order: list[Column],
    groups: list[str] | None = None,
    rank: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """Adds the 1-based position in its group; ``order`` must be a total order.

    ``total`` names an extra column with the size of the group.
    """
    groups = groups or []
    laid = _laid_out(df, order, groups)
    slices = laid.groupBy(_RANGE, *groups).agg(F.min(_AT).alias("_first"), F.count(F.lit(1)).alias("_n"))
    offsets = slices.select(
        _RANGE,
        *groups,
        "_first",
        F.coalesce(F.sum("_n").over(_before(groups)), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(_whole(groups)).alias(total)] if total else []),
    )
    placed = _with_offsets(laid, offsets, groups)
    return placed.withColumn(rank, F.col(_AT) - F.col("_first") + F.col("_before") + 1).drop(
        _AT, _RANGE, "_first", "_before"
    )


def running_totals(
    df: DataFrame,
    order: list[Column],
    totals: dict[str, str],
    groups: list[str] | None = None,
    overall: dict[str, str] | None = None,
) -> DataFrame:
    """Adds inclusive running sums ``{new column: summed column}`` in ``order``,
    and with ``overall`` the sums over the whole group."""
    groups, overall = groups or [], overall or {}
    laid = _laid_out(df, order, groups)
    summed = sorted(set(totals.values()) | set(overall.values()))
    slices = laid.groupBy(_RANGE, *groups).agg(*[F.sum(c).alias(f"_sum_{c}") for c in summed])
    offsets = slices.select(
        _RANGE,
        *groups,
        *[
            F.coalesce(F.sum(f"_sum_{c}").over(_before(groups)), F.lit(0)).alias(f"_before_{c}")
            for c in sorted(set(totals.values()))
        ],
        *[F.sum(f"_sum_{c}").over(_whole(groups)).alias(name) for name, c in overall.items()],
    )
    within = Window.partitionBy(_RANGE, *groups).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    placed = _with_offsets(
        laid.select("*", *[F.sum(c).over(within).alias(f"_run_{name}") for name, c in totals.items()]),
        offsets,
        groups,
    )
    return placed.select(
        *[c for c in placed.columns if not c.startswith(("_run_", "_before_")) and c not in (_AT, _RANGE)],
        *[(F.col(f"_run_{name}") + F.col(f"_before_{c}")).alias(name) for name, c in totals.items()],
    )


def _laid_out(df: DataFrame, order: list[Column], groups: list[str]) -> DataFrame:
    keys = [F.col(g).asc() for g in groups] + order
    at = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_AT, F.monotonically_increasing_id())
    return stage(at.withColumn(_RANGE, F.shiftright(_AT, _ROW_BITS)), "ordered")


def _before(groups: list[str]):
    return _whole(groups).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)


def _whole(groups: list[str]):
    return Window.partitionBy(*(groups or [F.lit(0)]))


def _with_offsets(laid: DataFrame, offsets: DataFrame, groups: list[str]) -> DataFrame:
    """Joins the per-(range, group) offsets; null groups match themselves."""
    small = pinned(offsets)
    renamed = small.select(
        *[F.col(c).alias(f"_key_{c}") for c in (_RANGE, *groups)],
        *[c for c in small.columns if c not in (_RANGE, *groups)],
    )
    match = reduce(
        lambda a, b: a & b,
        [F.col(g).eqNullSafe(F.col(f"_key_{g}")) for g in groups],
        F.col(_RANGE) == F.col(f"_key_{_RANGE}"),
    )
    return laid.join(renamed, match).drop(*[f"_key_{c}" for c in (_RANGE, *groups)])


def quantiles(
    rows: DataFrame,
    groups: list[str],
    value: str,
    probabilities: dict[str, float],
    interpolate: bool = False,
    error: float = 0.0,
    accuracy: int = 512,
) -> DataFrame:
    """One row per group with ``{name: quantile}`` of ``value``, nulls ignored.

    ``error`` > 0 answers from one mergeable sketch per group, ``error`` = 0
    exactly, by counting (see ``column_quantiles``). ``interpolate`` picks the
    continuous form.
    """
    columns = rows.select(*groups, F.col(value).alias("_v"))
    found = column_quantiles(columns, groups, ["_v"], "_name", probabilities, interpolate, error, accuracy)
    return found.drop("_name")


def column_quantiles(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    name: str,
    probabilities: dict[str, float],
    interpolate: bool = False,
    error: float = 0.0,
    accuracy: int = 512,
    extra: Callable[[Column], list[Column]] | None = None,
    step: int = 50,
) -> DataFrame:
    """``quantiles`` of many numeric columns: one row per (keys, ``name`` of the
    column), with ``extra`` aggregates of the column.

    Exact quantiles come from counting alone. A first aggregate gives each group's
    number of values, least and greatest one, and so the ranks that are asked for.
    Each further pass cuts the bracket around every open rank into ``accuracy``
    equal parts and counts the values in each part, with the least and greatest
    value there. The part that holds the rank is the next bracket; the rank is
    settled where a part holds one distinct value, or at a part's edge. Counts are
    exact in every pass, so no rank needs a proof afterwards, and a pass divides the
    distinct values in a bracket by about ``accuracy``: few passes do for any size.
    Parts are equal in value and in logarithm by turns, so far outliers cost a
    pass, not many. Values are counted where they lie; only counts are shuffled.

    ``error`` > 0 reads the quantiles off sketches, a few columns at a time.
    """
    numbers = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    if error > 0:
        return _sketched(numbers, keys, columns, name, probabilities, error, extra, step)
    if not keys:
        return column_quantiles(
            df.withColumn(_WHOLE, F.lit(0)), [_WHOLE], columns, name, probabilities, interpolate, 0.0, accuracy, extra, step
        ).drop(_WHOLE)
    summary = pinned(_measured(numbers, keys, columns, name, extra, step))
    others = [c for c in summary.columns if c not in (*keys, name, *_BOUNDS)]
    ranks = _ranks(probabilities, interpolate)
    asked = F.array(*[F.struct(F.lit(t).alias("t"), r.cast("long").alias("r")) for t, r in enumerate(ranks)])
    known = summary.where(F.col("_n") > 0).select(*keys, F.col(name).alias("_name"), *_BOUNDS[1:], F.explode(asked).alias("_a"))
    state = _settled(known.select(*keys, "_name", "_a.t", "_a.r", *_BOUNDS[1:]))
    done = [state]
    turn = 0
    while open_names := [r["_name"] for r in state.where(~F.col("_done")).select("_name").distinct().collect()]:
        state = stage(_narrowed(numbers, keys, open_names, state.where(~F.col("_done")), accuracy, turn, step), "brackets")
        done.append(state)
        turn += 1
    settled = reduce(DataFrame.unionByName, done).where("_done")
    answers = settled.groupBy(*keys, "_name").agg(
        *[F.max(F.when(F.col("t") == t, F.col("_low"))).alias(f"_q{t}") for t in range(len(ranks))]
    )
    keyed = answers.select(*[F.col(c).alias(f"_key_{c}") for c in keys], F.col("_name").alias("_key_name"), *[f"_q{t}" for t in range(len(ranks))])
    match = _same(keys) & (F.col(name) == F.col("_key_name"))
    return summary.join(keyed, match, "left").select(*keys, name, *others, *_picked(probabilities, interpolate))


_BOUNDS = ("_n", "_low", "_high", "_from", "_to")


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])


def _measured(numbers: DataFrame, keys: list[str], columns: list[str], name: str, extra, step: int) -> DataFrame:
    """Per (keys, column): number of values, least and greatest, the same of the
    finite ones, and the extra aggregates. Buffers of fixed size, so one scan per batch."""
    parts = []
    for batch in batches(columns, step):
        measures = []
        for c in batch:
            value = F.col(c)
            finite = F.when(F.abs(value) < float("inf"), value)
            found = [F.count(value), F.min(value), F.max(value), F.min(finite), F.max(finite)]
            own = [x.alias(n) for x, n in zip(found, _BOUNDS)]
            measures.append(F.struct(*own, *(extra(value) if extra else [])).alias(c))
        wide = numbers.groupBy(*keys).agg(*measures)
        parts.append(wide.unpivot(keys, batch, name, "_found").select(*keys, name, "_found.*"))
    return reduce(DataFrame.unionByName, parts)


def _ranks(probabilities: dict[str, float], interpolate: bool) -> list[Column]:
    """The 1-based ranks asked for, of ``_n`` values; two per quantile if interpolated."""
    n = F.col("_n")
    if not interpolate:
        return [F.greatest(F.ceil(F.lit(p) * n), F.lit(1)) for p in probabilities.values()]
    spots = [F.lit(p) * (n - 1) for p in probabilities.values()]
    return [r for spot in spots for r in (F.floor(spot) + 1, F.ceil(spot) + 1)]


def _picked(probabilities: dict[str, float], interpolate: bool) -> list[Column]:
    if not interpolate:
        return [F.col(f"_q{t}").alias(n) for t, n in enumerate(probabilities)]
    picks = []
    for t, (n, p) in enumerate(probabilities.items()):
        low, high, spot = F.col(f"_q{2 * t}"), F.col(f"_q{2 * t + 1}"), F.lit(p) * (F.col("_n") - 1)
        picks.append(F.when(low == high, low).otherwise(low + (high - low) * (spot - F.floor(spot))).alias(n))
    return picks


def _settled(brackets: DataFrame) -> DataFrame:
    """A bracket of one value is an answer."""
    return brackets.withColumn("_done", F.col("_low") == F.col("_high"))


def _narrowed(
    numbers: DataFrame, keys: list[str], columns: list[str], brackets: DataFrame, parts: int, turn: int, step: int
) -> DataFrame:
    """The next brackets (keys, _name, t, r, _low, _high, _from, _to, _done) of open ones."""
    # Ranks that share a bracket are counted once; the bracket goes by its first rank.
    shared = brackets.groupBy(*keys, "_name", *_BOUNDS[1:]).agg(F.min("t").alias("_id"), F.collect_list(F.struct("t", "r")).alias("_asked"))
    counts = reduce(DataFrame.unionByName, [_counted(numbers, keys, batch, shared, parts, turn) for batch in batches(columns, step)])
    inner = Window.partitionBy(*keys, "_name", "_id").orderBy("_part")
    counts = counts.withColumn("_upto", F.sum("_in").over(inner))
    asked = shared.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_name").alias("_key_name"), F.col("_id").alias("_key_id"), F.explode("_asked").alias("_a")
    )
    match = _same(keys) & (F.col("_name") == F.col("_key_name")) & (F.col("_id") == F.col("_key_id"))
    holds = (F.col("_a.r") <= F.col("_upto")) & (F.col("_a.r") > F.col("_upto") - F.col("_in"))
    found = counts.join(asked, match).where(holds)
    r = F.col("_a.r") - F.col("_upto") + F.col("_in")
    # The first and the last rank of a part are its least and greatest value.
    low = F.when((r == F.col("_in")) & (r > 1), F.col("_high")).otherwise(F.col("_low"))
    high = F.when(r == 1, F.col("_low")).otherwise(F.col("_high"))
    return _settled(
        found.select(*keys, "_name", "_a.t", r.alias("r"), low.alias("_low"), high.alias("_high"), low.alias("_from"), high.alias("_to"))
    )


def _counted(numbers: DataFrame, keys: list[str], columns: list[str], shared: DataFrame, parts: int, turn: int) -> DataFrame:
    """(keys, _name, _id, _part, _in, _low, _high): the values in each part of each bracket.

    The brackets come one row per group, a column for each column, so that they
    join the rows before these are unpivoted, on the keys alone.
    """
    own = F.collect_list(F.struct("_id", *_BOUNDS[1:]))
    wide = shared.where(F.col("_name").isin(columns)).groupBy(*keys, "_name").agg(own.alias("_b"))
    wide = wide.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        *[F.first(F.when(F.col("_name") == c, F.col("_b")), ignorenulls=True).alias(f"_b{i}") for i, c in enumerate(columns)]
    )
    rows = numbers.select(*keys, *columns).join(pinned(wide), _same(keys))
    pairs = rows.select(*keys, *[F.struct(F.col(c).alias("v"), F.col(f"_b{i}").alias("b")).alias(c) for i, c in enumerate(columns)])
    long = pairs.unpivot(keys, columns, "_name", "_pair")
    v = F.col("_pair.v")
    inside = F.filter("_pair.b", lambda b: (v >= b["_low"]) & (v <= b["_high"]))
    placed = long.select(*keys, "_name", v.alias("v"), F.explode(inside).alias("b"))
    return placed.groupBy(*keys, "_name", F.col("b._id").alias("_id"), _part(parts, turn).alias("_part")).agg(
        F.count(F.lit(1)).alias("_in"), F.min("v").alias("_low"), F.max("v").alias("_high")
    )


def _part(parts: int, turn: int) -> Column:
    """The part of bracket ``b`` that ``v`` is in, rising with ``v``; the greatest
    finite value has a part of its own, and so have the infinities and NaN."""

    def scale(x: Column) -> Column:
        # The logarithm of the least double is -744.4; moved up, both signs rise from 0.
        magnitude = F.when(x == 0, F.lit(0.0)).otherwise(F.ln(F.abs(x)) + 800)
        return x / 2 if turn % 2 == 0 else F.signum(x) * magnitude

    v, low, high = scale(F.col("v")), scale(F.col("b._from")), scale(F.col("b._to"))
    inner = F.least(F.floor(F.try_divide(v - low, high - low) * parts), F.lit(parts - 1))
    return (
        F.when(F.isnan("v"), F.lit(parts + 2))
        .when(F.col("v") == float("inf"), F.lit(parts + 1))
        .when(F.col("v") == float("-inf"), F.lit(-1))
        .when(F.col("v") >= F.col("b._to"), F.lit(parts))
        .otherwise(F.coalesce(inner, F.lit(0)))
        .cast("int")
    )


def _sketched(
    numbers: DataFrame, keys: list[str], columns: list[str], name: str, probabilities: dict[str, float], error: float, extra, step: int
) -> DataFrame:
    """Quantiles off one sketch per (keys, column). The sketches are taken side by
    side, grouped by ``keys`` only: grouped by (keys, column) there would be more
    groups per task than an aggregate on sketches keeps in its hash map, and it
    would sort all rows instead. Many groups take fewer columns at a time, so that
    a task's sketches stay bounded."""
    if keys:
        step = max(1, min(step, _SKETCHES // max(1, numbers.select(*keys).distinct().count())))
    names = sorted(probabilities, key=probabilities.get)
    wanted, size = [probabilities[n] for n in names], max(1, round(1 / error))
    parts = []
    for batch in batches(columns, step):
        measures = []
        for c in batch:
            sketch = F.percentile_approx(F.col(c), wanted, size).alias("_edges")
            measures.append(F.struct(sketch, *(extra(F.col(c)) if extra else [])).alias(c))
        wide = numbers.groupBy(*keys).agg(*measures)
        parts.append(wide.unpivot(keys, batch, name, "_found").select(*keys, name, "_found.*"))
    summary = reduce(DataFrame.unionByName, parts)
    others = [c for c in summary.columns if c not in (*keys, name, "_edges")]
    return summary.select(*keys, name, *others, *[F.get("_edges", F.lit(i)).alias(n) for i, n in enumerate(names)])
