"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``replicas`` points on a ring of 2**32 places. A row's key hash
falls into the arc before a point; the row goes to that point's shard unless
the shard is full, else on to the next points clockwise until one has room.
Loads are bounded by rows: with N rows and S shards every shard has room for
N // S rows, the first N % S shards for one more, so counts are at most one
apart. In round k the arcs, in ring order, offer what they still hold to the
shard of the k-th point clockwise; within an arc rows are taken by key hash.

Rows are counted per arc; the fill is worked out on these S * ``replicas``
counts, whatever the number of rows. Positions within arcs come from range
partitions, so a key with a third of the rows is split. Null keys hash like the
empty string; repeated keys lie side by side and may be cut between shards;
an empty table gives an empty result. Input columns ``shard`` and ``slot`` are
replaced; all others pass through, whatever they are called.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import ranked
from tidemark.sources.staging import stage

RING = 1 << 32
_CELL_BITS = 20


@dataclass(frozen=True)
class RingSpec:
    shards: int = 8
    replicas: int = 128


def points(spec: RingSpec) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes in ring order."""
    made = [
        (int.from_bytes(hashlib.md5(f"{s}:{r}".encode()).digest()[:4]), s)
        for s in range(spec.shards)
        for r in range(spec.replicas)
    ]
    return sorted(made)


def key_place(key: Column) -> Column:
    """The key's place on the ring."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def fill(counts: Sequence[int], owners: Sequence[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, slot): rows ``from`` to ``to - 1`` of an arc get
    the shard's slots from ``slot`` on."""
    total, arcs = sum(counts), len(owners)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, done, pieces = [0] * shards, [0] * arcs, []
    left = {a for a in range(arcs) if counts[a]}
    for step in range(arcs):
        for a in sorted(left):
            shard = owners[(a + step) % arcs]
            n = min(counts[a] - done[a], room[shard] - used[shard])
            if n:
                pieces.append((a, done[a], done[a] + n, shard, used[shard]))
                done[a] += n
                used[shard] += n
                if done[a] == counts[a]:
                    left.discard(a)
        if not left:
            break
    return pieces


def _cells(places: list[int]) -> list[tuple[int, int, int, int]]:
    """(cell, from, to, arc): the ring cut at the points and at every cell border."""
    width = 1 << _CELL_BITS
    cuts = sorted({0, RING, *range(0, RING, width), *(p + 1 for p in places)})
    return [(a // width, a, b, bisect_left(places, a) % len(places)) for a, b in zip(cuts, cuts[1:]) if a < RING]


def place(rows: DataFrame, key: str, tie: list[str], spec: RingSpec = RingSpec()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the gapless number within the shard.

    Rows with equal ``key`` are ordered by the ``tie`` columns.
    """
    spark = rows.sparkSession
    ring = points(spec)
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    own = dict(zip(rows.columns, plain.columns))
    # S * replicas + 4096 rows, whatever the data.
    cells = F.broadcast(
        spark.createDataFrame(_cells([p for p, _ in ring]), "_cell long, _from long, _to long, _arc int")
    )
    at = F.col("_place")
    placed = plain.withColumn("_place", key_place(F.col(own[key])))
    on = (F.shiftright(at, _CELL_BITS) == F.col("_cell")) & (at >= F.col("_from")) & (at < F.col("_to"))
    placed = stage(placed.join(cells, on).drop("_cell", "_from", "_to"), "ring")
    counts = {r["_arc"]: r["count"] for r in placed.groupBy("_arc").count().collect()}
    pieces = fill([counts.get(a, 0) for a in range(len(ring))], [s for _, s in ring], spec.shards)
    order = [F.col(c).asc() for c in ("_place", *[own[c] for c in (key, *tie)])]
    numbered = ranked(placed, order, ["_arc"], rank="_rank")
    # At most one row per arc and shard.
    table = F.broadcast(
        spark.createDataFrame(pieces, "_piece_arc int, _from long, _to long, shard int, _slot long")
    )
    rank = F.col("_rank") - 1
    on = (F.col("_arc") == F.col("_piece_arc")) & (rank >= F.col("_from")) & (rank < F.col("_to"))
    return numbered.join(table, on).select(
        *[F.col(c).alias(name) for name, c in own.items() if name.lower() not in ("shard", "slot")],
        "shard",
        (F.col("_slot") + rank - F.col("_from")).alias("slot"),
    )
