"""The trie of conversation prefixes, by vertical bitmaps.

Conversations are numbered in order of their ids and cut into shards of
``shard`` conversations; positions are cut into bands of ``band`` turns. A cell
(shard, band) indexes (position, turn) to a bitset of its conversations and walks
the trie depth first: a node's bitset without the part already dealt out, met
with the posting of the turn that its lowest conversation says next, is a child.
Bit counts give the members, the lowest bit the least member, and the bits whose
conversation stops there the end list. The cells of later bands start from the
nodes in which the earlier ones stop: a node is known by the XOR of two 64-bit
hashes of its (position, turn) pairs, which Spark sums up to each band's start.
Cells are bounded in rows, so a long conversation or a common first turn is no
large group; Spark adds up the cells of a node.

Sums over subtrees need no walk. A node belongs to its least member, and what a
member owns is one stretch of its path, down to its end. So the nodes below a
node at depth d are, over all its members, those that the members own from depth
d on; only the owner itself owns anything above. The sum over a subtree is the
members' whole sums, less the part of the owner's stretch above the node.

Defined cases. Turns are ordered by turn, null first, ties by role and then by
text hash; null role or text is the empty text, repeated rows are turns of their
own. Rows without a conversation id belong to no conversation. A conversation
without turns ends at the root; without conversations there are no nodes.
Columns not named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import ranked, running_totals
from tidemark.operators.skew import split_join
from tidemark.sources.staging import stage

_NODE = ["n1", "n2"]
_PARENT = ["p1", "p2"]
# End lists travel in pieces of so many ids.
_PIECE = 256
_FOUND = (
    "n1 long, n2 long, p1 long, p2 long, depth long, chars long, shard long, n_convs long, conv_id long,"
    " members array<long>, ends array<long>"
)


@dataclass(frozen=True)
class TrieSpec:
    shard: int = 512
    band: int = 64


@dataclass(frozen=True)
class Trie:
    """``nodes``: n1, n2, conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens. ``ends``: n1, n2, shard, ids, the conversations that
    end at a node, rising within and between shards."""

    nodes: DataFrame
    ends: DataFrame


def positions(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, t1, t2, chars): turns as hashes, numbered from 1."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    thin = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        said[0].alias("role"),
        F.xxhash64(*said).alias("t1"),
        F.xxhash64(F.lit(1), *said).alias("t2"),
        F.length(said[1]).cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("t1").asc(), F.col("t2").asc()]
    return ranked(thin, order, ["conv"], "pos").drop("turn", "role")


def build(turns: DataFrame, convs: DataFrame, spec: TrieSpec = TrieSpec()) -> Trie:
    """The trie of ``turns`` (conv, pos from 1 without gaps, t1, t2, chars) and
    ``convs`` (conv, length), which lists every conversation with its number of turns."""
    cells = stage(_cells(turns, convs, spec), "cells")
    found = stage(cells.groupBy("shard", "band").applyInArrow(_walk, _FOUND), "nodes")
    nodes = found.groupBy(*_NODE, "depth").agg(
        *[F.max(c).alias(c) for c in (*_PARENT, "chars")], F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    children = nodes.where(F.col("p1").isNotNull()).groupBy(*_PARENT).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children.toDF(*_NODE, "n_children"), _NODE, "left")
    nodes = stage(
        nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
        .withColumn("leaf", (F.col("n_children") == 0).cast("long")),
        "nodes",
    )
    # What an owner owns from each of its nodes on.
    owned = running_totals(nodes, [F.col("depth").desc()], {"from_here": "saved"}, ["conv_id"], {"owner_all": "saved"})
    stretch = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    stretch = stretch.join(convs.select("conv", (F.col("length") + 1).alias("met")), "conv")
    members = found.select(*_NODE, F.explode("members").alias("conv"))
    below = split_join(members, stretch, ["conv"], "met").groupBy(*_NODE)
    below = below.agg(F.sum("saved").alias("members_all"), F.sum("leaf").alias("n_leaves"))
    parents = nodes.where(F.col("n_children") > 0).select(
        F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    whose = split_join(nodes.select(*_NODE, *_PARENT), parents, _PARENT, "n_children").drop(*_PARENT)
    whole = owned.join(below, _NODE).join(whose, _NODE, "left")
    return Trie(
        whole.select(
            *_NODE, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("from_here") + F.col("members_all") - F.col("owner_all")).alias("saved_tokens"),
        ),
        found.where(F.size("ends") > 0).select(*_NODE, "shard", F.col("ends").alias("ids")),
    )


def digests(trie: Trie) -> DataFrame:
    """(n1, n2, ends_sha256) of all nodes: SHA-256 of the decimal ids, rising, joined by commas.

    A digest is a sequence: the pieces of a node's list stream through one task in
    order, a piece at a time. Nothing is held but the digest.
    """
    count = F.ceil(F.size("ids") / _PIECE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice("ids", i * _PIECE + 1, F.lit(_PIECE)))
    pieces = trie.ends.select(*_NODE, "shard", F.posexplode(cut).alias("piece", "ids"))
    dealt = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "shard", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, told = None, None
        for batch in batches:
            done = []
            for one, two, ids in zip(*[batch.column(c).to_pylist() for c in (*_NODE, "ids")]):
                if (one, two) != node:
                    if node:
                        done.append((*node, told.hexdigest()))
                    node, told, gap = (one, two), hashlib.sha256(), ""
                told.update((gap + ",".join(map(str, ids))).encode())
                gap = ","
            yield _batch(done)
        if node:
            yield _batch([(*node, told.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_NODE, "ends_sha256"])

    told = dealt.mapInArrow(run, "n1 long, n2 long, ends_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return trie.nodes.select(*_NODE).join(told, _NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))


def _cells(turns: DataFrame, convs: DataFrame, spec: TrieSpec) -> DataFrame:
    """A row for each turn, and one without chars for each (conversation, band) with the hash at its start."""
    numbered = ranked(convs.select("conv", "length"), [F.col("conv").asc()], rank="no").select(
        "conv",
        "length",
        F.floor((F.col("no") - 1) / spec.shard).alias("shard"),
        ((F.col("no") - 1) % spec.shard).cast("int").alias("bit"),
    )
    pair = [F.xxhash64("pos", "t1", "t2").alias("h1"), F.xxhash64(F.lit(1), "pos", "t1", "t2").alias("h2")]
    placed = split_join(turns, numbered.withColumn("met", F.col("length")), ["conv"], "met").select(
        "shard",
        F.floor((F.col("pos") - 1) / spec.band).alias("band"),
        "bit",
        F.col("pos").cast("long").alias("pos"),
        *pair,
        "chars",
        (F.col("pos") == F.col("length")).alias("last"),
        "conv",
    )
    placed = stage(placed, "turns")
    before = Window.partitionBy("shard", "bit").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("shard", "bit", "conv", "band").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    starts = sums.select(
        "shard",
        "band",
        "bit",
        (F.col("band") * spec.band).alias("pos"),
        F.bit_xor("x1").over(before).alias("h1"),
        F.bit_xor("x2").over(before).alias("h2"),
        F.lit(None).cast("long").alias("chars"),
        F.lit(False).alias("last"),
        "conv",
    ).where(F.col("band") > 0)
    zero = F.lit(0).cast("long")
    roots = numbered.select(
        "shard", zero.alias("band"), "bit", zero.alias("pos"), zero.alias("h1"), zero.alias("h2"),
        F.lit(None).cast("long").alias("chars"), (F.col("length") == 0).alias("last"), "conv",
    )
    return placed.unionByName(starts).unionByName(roots)


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def _walk(key: tuple, rows: pa.Table) -> pa.Table:
    """The nodes of one cell, each with its members and those that end there."""
    shard, band = key[0].as_py(), key[1].as_py()
    ids: dict[int, int] = {}
    postings: dict[int, dict[tuple[int, int], int]] = {}
    says: dict[int, dict[int, tuple[int, int]]] = {}
    held: dict[int, int] = {}
    stops: dict[int, int] = {}
    chars: dict[tuple[int, int], int] = {}
    starts: dict[tuple[int, int], int] = {}
    top = 0
    columns = [rows.column(c).to_pylist() for c in ("bit", "pos", "h1", "h2", "chars", "last", "conv")]
    for bit, pos, h1, h2, n, last, conv in zip(*columns):
        mark, turn = 1 << bit, (h1, h2)
        if n is None:
            starts[turn] = starts.get(turn, 0) | mark
            ids[bit], top = conv, pos
        else:
            at = postings.setdefault(pos, {})
            at[turn] = at.get(turn, 0) | mark
            says.setdefault(pos, {})[bit] = turn
            held[pos] = held.get(pos, 0) | mark
            chars[turn] = n
        if last:
            stops[pos] = stops.get(pos, 0) | mark
    out: list[tuple] = []

    def told(node: tuple, parent: tuple, depth: int, length: int, bits: int) -> None:
        members = [ids[b] for b in _bits(bits)]
        ends = [ids[b] for b in _bits(bits & stops.get(depth, 0))]
        out.append((*node, *parent, depth, length, shard, len(members), members[0], members, ends))

    if band == 0:
        for node, bits in starts.items():
            told(node, (None, None), 0, 0, bits)
    stack = [(node, top, bits) for node, bits in starts.items()]
    while stack:
        node, depth, bits = stack.pop()
        depth += 1
        rest = bits & held.get(depth, 0)
        while rest:
            turn = says[depth][(rest & -rest).bit_length() - 1]
            child = rest & postings[depth][turn]
            rest ^= child
            below = (node[0] ^ turn[0], node[1] ^ turn[1])
            told(below, node, depth, chars[turn], child)
            stack.append((below, depth, child))
    names = ["n1", "n2", "p1", "p2", "depth", "chars", "shard", "n_convs", "conv_id", "members", "ends"]
    kinds = [pa.int64()] * 9 + [pa.list_(pa.int64())] * 2
    columns = list(zip(*out)) or [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
