"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources in code-point order (null last) take the given weights in turn and
share ``share`` times all sizes; a target stops at ``most`` times its source's
size and the excess is shared again by weight. The total is cut into blocks of
``block`` words. Blocks go one by one to the source with the highest quotient
target / (2 * blocks so far + 1), ties to the earlier source; cut evenly, the
sequence gives every output shard an integer quota of each source. Within a
source, rows are ordered by a seeded hash; the shards take their quotas one
after the other along that order, which begins again when every row is taken
once. A row may thus have parts in several shards.

The sequence itself is never laid out, so its length costs nothing and one-word
blocks bring every source within a word or so of its target, whatever its size.
Of the first h blocks a source surely has what the divisor for h - (s / 2 + 1)
blocks gives it, s being the number of sources, and at most what the divisor for
h + (s / 2 + 1) gives; only the quotients between the two, at most 2 * s + 2 in
all, are ranked. A source opens a part of these as large as its part of all
targets.

Sources are a table of any length; nothing of it reaches the driver. Ranks and
running totals come from range partitions, and sources that hold many rows meet
them by a broadcast, so a source that holds a third of all rows is split. Rows
without size take nothing; an empty table gives an empty result; equal rows are
interchangeable. Result columns replace input columns of the same names; all
other columns pass through, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import ranked, running_totals
from tidemark.operators.skew import split_join
from tidemark.sources.staging import pinned, stage

RESULT = ("source_size", "target", "taken", "shard", "parts")


@dataclass(frozen=True)
class MixSpec:
    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: int = 2
    block: int = 1
    shards: int = 8
    seed: int = 7

    def __post_init__(self):
        if min(self.weights) <= 0 or min(self.share, self.most, self.block, self.shards) <= 0:
            raise ValueError("weights, share, most, block and shards must be above 0")


def targets(sizes: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """``sizes``, with source and n, one row per source; adds ``place`` in source
    order, ``target`` and ``wanted``, the sum of all targets."""
    numbered = ranked(sizes, [F.col("source").asc_nulls_last()], rank="place")
    given = F.array(*[F.lit(float(w)) for w in spec.weights])
    numbered = numbered.withColumns(
        {"w": F.get(given, ((F.col("place") - 1) % len(spec.weights)).cast("int")), "most": F.col("n") * spec.most}
    ).withColumn("ratio", F.col("most") / F.col("w"))
    # Sources reach their limits in the order of limit / weight.
    summed = running_totals(
        numbered,
        [F.col("ratio").asc(), F.col("place").asc()],
        {"most_upto": "most", "w_upto": "w"},
        overall={"n_all": "n", "w_all": "w"},
    )
    # Limits bind everything if the share is above them.
    wanted = F.lit(float(min(spec.share, spec.most))) * F.col("n_all")
    level = (wanted - (F.col("most_upto") - F.col("most"))) / (F.col("w_all") - (F.col("w_upto") - F.col("w")))
    summed = pinned(summed.withColumns({"wanted": wanted, "level": level}))
    first = summed.where(F.col("w") * F.col("level") <= F.col("most"))
    level = first.agg(F.min_by("level", F.struct("ratio", "place"))).scalar()
    target = F.coalesce(F.least(F.col("w") * level, F.col("most").cast("double")), F.col("most").cast("double"))
    return summed.select(*sizes.columns, "place", target.alias("target"), "wanted")


def apportion(goals: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """(place, ends): how many of the words that a source gives lie before the end
    of each shard. ``goals`` as ``targets`` gives them; no row for a target of 0."""
    goals = goals.where("target > 0")
    blocks = F.floor(F.col("wanted") / spec.block + 0.5)
    spread = goals.select((F.count(F.lit(1)) / 2 + 1)).scalar()
    cut = goals.select("place", "target", "wanted", blocks.alias("m"), F.explode(F.sequence(F.lit(1), F.lit(spec.shards))).alias("s"))
    cut = cut.withColumns({"house": F.floor(F.col("m") * F.col("s") / spec.shards), "spread": spread})

    def seats(house: Column) -> Column:
        return F.floor(F.col("target") * house / F.col("wanted") + 0.5)

    cut = cut.withColumns(
        {"sure": seats(F.greatest(F.col("house") - F.col("spread"), F.lit(0.0))), "top": seats(F.col("house") + F.col("spread"))}
    )
    cut = pinned(cut.select("place", "target", "s", "house", "sure", "top"))
    left = cut.groupBy(F.col("s").alias("of")).agg((F.max("house") - F.sum("sure")).alias("open"))
    tried = cut.where("top > sure").select("place", "target", "s", F.explode(F.sequence("sure", F.col("top") - 1)).alias("k"))
    tried = tried.select("place", "s", "k", (F.col("target") / (2 * F.col("k") + 1)).alias("quotient"))
    order = [F.col("quotient").desc(), F.col("place").asc(), F.col("k").asc()]
    won = ranked(tried, order, ["s"]).join(left, F.col("s") == F.col("of")).where(F.col("rank") <= F.col("open"))
    won = won.groupBy("place", "s").agg(F.count(F.lit(1)).alias("more"))
    whole = cut.join(won, ["place", "s"], "left").select(
        "place", F.struct("s", ((F.col("sure") + F.coalesce("more", F.lit(0))) * spec.block).alias("end")).alias("cut")
    )
    # As many entries as shards.
    return whole.groupBy("place").agg(F.array_sort(F.collect_list("cut"))["end"].alias("ends"))


def mix(rows: DataFrame, key: str, size: str, source: str, tie: list[str], spec: MixSpec = MixSpec()) -> DataFrame:
    """``rows`` with ``source_size``, ``target``, ``taken``, ``shard`` and ``parts``.

    ``parts`` has (shard, words) for each output shard that takes words of the
    row, repeats counted; over all rows of a source they sum up to the shard's
    quota, less what a last block has beyond ``most`` times the source. ``taken`` is their sum, ``shard`` the first, null if nothing is taken.
    ``size`` must be a whole number of at least 0; rows with equal ``key`` are
    ordered by the ``tie`` columns.
    """
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    own = dict(zip(rows.columns, plain.columns))
    salted = F.md5(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col(own[key]).cast("string"), F.lit(""))))
    keyed = plain.withColumns(
        {"order": salted, "size": F.col(own[size]), "source": F.col(own[source]).cast("string")}
    )
    keyed = stage(keyed, "mix")
    sizes = pinned(keyed.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")))
    goals = pinned(targets(sizes, spec))
    found = pinned(goals.join(apportion(goals, spec), "place", "left").drop("place", "wanted"))
    order = [F.col(c).asc() for c in ("order", *[own[c] for c in (key, *tie)], "size")]
    placed = running_totals(keyed, order, {"until": "size"}, ["source"]).drop("order")
    # Null is a source like any other.
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name")
    placed = stage(placed.select("*", name).drop("source"), "placed")
    joined = split_join(placed, found.select("*", name).drop("source"), ["name"], "rows")

    def words(shard: Column) -> Column:
        """The row's words in the shard: its places in every round that the shard's span covers."""
        low = F.when(shard > 0, F.get("ends", shard - 1)).otherwise(F.lit(0))
        rounds = [F.lit(r) * F.col("n") for r in range(spec.most)]
        upto = [F.least(F.get("ends", shard), r + F.col("until")) for r in rounds]
        since = [F.greatest(low, r + F.col("until") - F.col("size")) for r in rounds]
        return reduce(Column.__add__, [F.greatest(u - s, F.lit(0)) for u, s in zip(upto, since)]).cast("long")

    shards = F.array(*[F.lit(s) for s in range(spec.shards)])
    parts = F.transform(shards, lambda s: F.struct(s.alias("shard"), F.coalesce(words(s), F.lit(0)).alias("words")))
    parted = joined.withColumn("parts", F.filter(parts, lambda p: p["words"] > 0))
    return parted.select(
        *[F.col(c).alias(name) for name, c in own.items() if name.lower() not in RESULT],
        F.col("n").alias("source_size"),
        "target",
        F.aggregate("parts", F.lit(0).cast("long"), lambda done, p: done + p["words"]).alias("taken"),
        F.get("parts", F.lit(0))["shard"].alias("shard"),
        "parts",
    )


ORACLE = r"""
with sized as (
  select doc_id, source, case when text is null then 0
    else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end as size,
    md5('7:' || coalesce(doc_id::varchar, '')) as ord, md5(coalesce(text, '')) as tie
  from documents),
per as (
  select source, sum(size)::bigint as n,
    (array[3, 1, 2])[1 + ((row_number() over (order by source nulls last) - 1) % 3)::int] as w,
    row_number() over (order by source nulls last) as i
  from sized group by source),
total as (select 1.5 * sum(n) as t from per),
-- Caps bind in the order of cap / weight; level after the k sources with the least are full.
caps as (
  select *, 2 * n as cap, row_number() over (order by 2.0 * n / w, i) as k,
    sum(w) over () as all_w,
    coalesce(sum(2 * n) over (order by 2.0 * n / w, i rows between unbounded preceding and 1 preceding), 0) as cap_before,
    coalesce(sum(w) over (order by 2.0 * n / w, i rows between unbounded preceding and 1 preceding), 0) as w_before
  from per),
level as (
  select arg_min((t - cap_before)::double / (all_w - w_before), k)
    filter (where w * ((t - cap_before)::double / (all_w - w_before)) <= cap) as lv
  from caps, total),
goal as (
  select source, n, i, case when lv is null or w * lv > cap then cap::double else w * lv end as target from caps, level),
house as (
  select floor(t + 0.5)::bigint as m, t::double as t, (select count(*) from goal where target > 0) / 2 + 1 as spread from total),
bounds as (
  select g.*, m, floor(target * greatest(m - spread, 0) / t + 0.5)::bigint as sure,
    floor(target * (m + spread) / t + 0.5)::bigint as most
  from goal g, house where target > 0),
ranked as (
  select i, row_number() over (order by target / (2 * s + 1) desc, i, s) as r
  from bounds, lateral (select unnest(range(sure, most)) as s)),
won as (
  select i, count(*) as more from ranked where r <= (select any_value(m) - sum(sure) from bounds) group by i),
take as (
  select g.source, g.n, g.target, least(coalesce(b.sure, 0) + coalesce(more, 0), 2 * g.n)::bigint as taken
  from goal g left join bounds b using (i) left join won using (i)),
placed as (
  select d.*, t.n as source_size, t.target, t.taken as goal_taken,
    sum(size) over (partition by d.source order by ord, doc_id nulls first, tie, size rows unbounded preceding) - size as start
  from sized d join take t on d.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
  (case when source_size = 0 then 0 else (goal_taken // source_size) * size
    + greatest(least(goal_taken - (goal_taken // source_size) * source_size - start, size), 0) end)::bigint as taken
from placed
"""
