"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits a label's vectors again and again at the median of a random
projection; vectors within ``spill`` of a split go down both sides. The depth
grows with the logarithm of the largest label. The splits of one level of a
tree share their projection and threshold, so a vector's way through a tree is
a pattern of sides and spills, and two vectors meet in a tree exactly if their
sides agree wherever neither spilled. A pair is counted in the first leaf of
the first tree where it meets, so counts need no list of pairs. Vectors in a
leaf are compared in cells of two blocks, every pair by cosine in double
precision; a cell returns a number of links per vector and a spanning forest.

Thresholds come from a bounded sample: the ``sample`` vectors with the lowest
key hash. Every vector is indexed. Equal vectors of a label collapse to one,
with their number. A pair is missed if it is separated in every tree; with the
defaults that is well below one pair in a thousand at the threshold itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.sources.staging import stage


@dataclass(frozen=True)
class ForestSpec:
    cosine: float = 0.93
    trees: int = 5
    leaf: int = 256
    spill: float = 0.5
    block: int = 512
    sample: int = 4096
    seed: int = 5


@dataclass(frozen=True)
class Forest:
    """Per tree and level a direction; ``thresholds`` of normalised vectors."""

    directions: np.ndarray
    thresholds: np.ndarray
    margin: float

    def sides(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Side bits and spill bits, one number per vector and tree."""
        away = np.einsum("nd,tld->ntl", unit, self.directions) - self.thresholds
        bits = 1 << np.arange(self.directions.shape[1], dtype=np.int64)
        return ((away >= 0) * bits).sum(axis=2), ((np.abs(away) <= self.margin) * bits).sum(axis=2)


def grow(unit: np.ndarray, width: int, most: int, spec: ForestSpec) -> Forest:
    """A forest for groups of at most ``most`` vectors, from a sample of unit vectors.

    The margin is a share of the spread of projected differences at the threshold.
    """
    depth = min(40, max(1, math.ceil(math.log2(max(2, most / spec.leaf)))))
    made = np.random.default_rng(spec.seed).normal(size=(spec.trees, depth, width))
    made /= np.linalg.norm(made, axis=2, keepdims=True)
    middle = np.median(np.einsum("nd,tld->ntl", unit, made), axis=0) if len(unit) else np.zeros((spec.trees, depth))
    spread = math.sqrt((2 - 2 * spec.cosine) / width)
    return Forest(made, middle, spec.spill * spread)


def leaves(side: int, spilled: int) -> Iterator[int]:
    """All leaves of a vector: every choice of side where it spilled."""
    part = spilled
    while True:
        yield (side & ~spilled) | part
        if not part:
            break
        part = (part - 1) & spilled


def _clean(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, v), ``v`` null for vectors that link with nothing."""
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = sound & F.exists(values, lambda x: x != 0) & F.col(label).isNotNull()
    return vectors.select(
        F.col(key).cast("long").alias("key"),
        F.col(label).cast("string").alias("label"),
        F.when(F.coalesce(usable, F.lit(False)), values).alias("v"),
    )


def _unit(batch: np.ndarray) -> np.ndarray:
    scaled = batch / np.abs(batch).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _in_leaves(reps: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """(label, width, tree, leaf, rep, n, v, sides, spills), a row for each leaf of a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            for width, part in rows.groupby(rows["v"].map(len)):
                for at in range(0, len(part), 1024):
                    some = part.iloc[at : at + 1024]
                    unit = _unit(np.stack(some["v"].to_numpy()).astype(float))
                    side, spilled = forests[int(width)].sides(unit)
                    out = [
                        (label, width, t, leaf, rep, n, u.tobytes(), s.tobytes(), p.tobytes())
                        for label, rep, n, u, s, p in zip(some["label"], some["rep"], some["n"], unit, side, spilled)
                        for t in range(len(s))
                        for leaf in leaves(int(s[t]), int(p[t]))
                    ]
                    names = ["label", "width", "tree", "leaf", "rep", "n", "v", "sides", "spills"]
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names), preserve_index=False)

    return reps.select("label", "rep", "n", "v").mapInArrow(
        run, "label string, width long, tree long, leaf long, rep long, n long, v binary, sides binary, spills binary"
    )


_LEAF = ("label", "width", "tree", "leaf")


def _compare(spec: ForestSpec):
    """A cell's links: (rep, n) counts with null ``other``, and forest edges (rep, other)."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, width, tree, leaf, low, high = key
        rows = rows.sort_values("rep", ignore_index=True)
        ids, counts = rows["rep"].to_numpy(), rows["n"].to_numpy()
        unit = np.frombuffer(b"".join(rows["v"])).reshape(len(ids), width)
        sides = np.frombuffer(b"".join(rows["sides"]), np.int64).reshape(len(ids), -1)
        spills = np.frombuffer(b"".join(rows["spills"]), np.int64).reshape(len(ids), -1)
        block = rows["block"].to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        x, y = np.nonzero(unit[left] @ unit[right].T >= spec.cosine)
        a, b = left[x], right[y]
        if low == high:
            a, b = a[x < y], b[x < y]
        # Where both spilled, the pair also meets in the leaf with the lower side: count it there.
        first = (spills[a, tree] & spills[b, tree] & leaf) == 0
        for t in range(tree):
            first &= ((sides[a, t] ^ sides[b, t]) & ~(spills[a, t] | spills[b, t])) != 0
        a, b = a[first], b[first]
        linked = np.bincount(a, counts[b], len(ids)) + np.bincount(b, counts[a], len(ids))
        root = np.arange(len(ids))
        while True:
            low_root = np.minimum(root[a], root[b])
            after = root.copy()
            np.minimum.at(after, a, low_root)
            np.minimum.at(after, b, low_root)
            np.minimum.at(after, root[a], low_root)
            np.minimum.at(after, root[b], low_root)
            after = after[after]
            if (after == root).all():
                break
            root = after
        some, moved = np.flatnonzero(linked), np.flatnonzero(root != np.arange(len(ids)))
        return pd.DataFrame(
            {
                "rep": np.concatenate([ids[some], ids[moved]]),
                "other": pd.array([pd.NA] * len(some) + ids[root[moved]].tolist(), "Int64"),
                "n": np.concatenate([linked[some], np.zeros(len(moved))]).astype(np.int64),
            }
        )

    return run


def near_vectors(
    vectors: DataFrame, key: str, vector: str, label: str, spec: ForestSpec = ForestSpec()
) -> DataFrame:
    """(``key``, ``n_links``, ``component_id``, ``kept``), one row per row of ``vectors``.

    Vectors that are null, zero or hold null or non-finite components, rows
    without a label, and vectors of different lengths link with nothing. A row
    without a key gets a null ``component_id``, counts as nobody's link and is kept.
    """
    rows = stage(_clean(vectors, key, vector, label), "vectors")
    usable = rows.where(F.col("v").isNotNull() & F.col("key").isNotNull())
    reps = usable.groupBy("label", "v").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n"))
    reps = stage(reps, "vectors")
    # One row per vector length; a group of vectors shares label and length.
    sizes = reps.groupBy("label", F.size("v").alias("w")).count().groupBy("w").agg(F.max("count").alias("most"))
    lengths = {r["w"]: r["most"] for r in sizes.limit(1001).collect()}
    if len(lengths) > 1000:
        raise ValueError("more than 1000 vector lengths")
    forests = {}
    for width, most in lengths.items():
        chosen = reps.where(F.size("v") == width).orderBy(F.xxhash64("rep"), "rep").limit(spec.sample).select("v")
        unit = _unit(np.array([r["v"] for r in chosen.collect()], float).reshape(-1, width))
        forests[int(width)] = grow(unit, int(width), int(most), spec)
    placed = stage(_in_leaves(reps, forests), "leaves")
    sized = placed.groupBy(*_LEAF).agg(F.ceil(F.count(F.lit(1)) / spec.block).alias("blocks"))
    sized = sized.toDF(*[f"_{c}" for c in _LEAF], "blocks")
    on = [F.col(c) == F.col(f"_{c}") for c in _LEAF]
    blocks = placed.join(sized, on).drop(*[f"_{c}" for c in _LEAF])
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    cells = blocks.withColumn("_other", other).select(
        *_LEAF, F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
        "rep", "n", "v", "sides", "spills", "block",
    )
    found = cells.groupBy(*_LEAF, "low", "high").applyInPandas(_compare(spec), "rep long, other long, n long")
    found = stage(found, "vector-links")
    counts = found.where(F.col("other").isNull()).groupBy(F.col("rep").alias("_rep")).agg(F.sum("n").alias("_linked"))
    groups = components(found.where(F.col("other").isNotNull()), "rep", "other").toDF("_node", "_component")
    known = reps.join(counts, F.col("rep") == F.col("_rep"), "left").join(groups, F.col("rep") == F.col("_node"), "left")
    known = known.select(
        F.col("label").alias("_label"),
        F.col("v").alias("_v"),
        (F.coalesce("_linked", F.lit(0)) + F.col("n") - 1).alias("_links"),
        F.coalesce("_component", "rep").alias("_group"),
    )
    joined = rows.join(known, (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
    own = F.when(F.col("key").isNotNull(), F.coalesce("_group", "key"))
    return joined.select(
        F.col("key").alias(key),
        F.when(F.col("key").isNotNull(), F.coalesce("_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.col("key").eqNullSafe(own).alias("kept"),
    )
