"""Hard negatives by a vertical scan with shrinking candidate bitmaps (BOND).

Vectors are cut to integers, ``floor(scale * x)``, and packed into blocks of at
most ``block`` rows that are stored by dimension, with each dimension's least
and greatest value. Anchors are packed alike. Every (anchor block, row block)
that can matter is a cell. In a cell each anchor reads the dimensions in falling
order of its own magnitudes, a few at a time, and adds their part of the inner
product for the rows still in its bitmap. What the unread dimensions can add at
least and at most follows from the block's ranges; a row leaves the bitmap as
soon as its bounds show that it cannot be in the answer. The rows that are left
at the end have exact scores.

Two scans: the ``positives`` best rows of the anchor's label, in the blocks that
hold that label; then, for each positive of score p, the best ``negatives`` rows
of other labels with ``low * p <= 100 * score <= high * p``, in all blocks. A cell
returns its best few per anchor and window, Spark merges them.

Work grows with anchors times rows, in blocks: the answer is exact, bounds only
spare dimensions. Equal rows (key, label, cut vector) collapse before the blocks
are cut by range, so neither a hot key nor a hot label fills a task.

Defined cases. Rows with a null label or vector, or with a null or non-finite
component, take no part; an empty vector scores 0. Rows of other lengths never
meet. Equal rows count once; rows of one key with other contents each take
part, and a row never is a positive or negative of its own key. Ties go to the
smaller key, a null key comes last and is no anchor. Components and scores
beyond the range of a long are taken as its nearest end. Empty table, or no
anchors: no rows. Columns besides key, vector and label are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.staging import stage

_BLOCK = "d long, keys array<long>, labels array<long>, matrix binary, short boolean"
_EXACT = float(1 << 53)
_LONG = (-(1 << 63), (1 << 63) - 1)
# Dimensions read between two looks at the bounds.
_STEP = 8


@dataclass(frozen=True)
class NegativeSpec:
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    block: int = 4096
    anchors: int = 256


@dataclass
class Block:
    """Rows by dimension, with each dimension's range."""

    keys: np.ndarray
    nulls: np.ndarray
    labels: np.ndarray
    columns: np.ndarray

    def __post_init__(self) -> None:
        self.least = self.columns.min(axis=1)
        self.most = self.columns.max(axis=1)

    @staticmethod
    def of(table: pa.Table) -> Block:
        row = {name: table.column(name)[0] for name in ("d", "keys", "labels", "matrix", "short")}
        keys = row["keys"].values
        kind = np.int16 if row["short"].as_py() else np.int64
        matrix = np.frombuffer(row["matrix"].as_py(), kind).reshape(row["d"].as_py(), len(keys))
        nulls = np.asarray(keys.is_null())
        return Block(np.asarray(keys.fill_null(0)), nulls, np.asarray(row["labels"].values), matrix)


def scan(
    anchor: np.ndarray, block: Block, alive: np.ndarray, narrow: Callable[[np.ndarray, float, float], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the bitmap ``alive`` that ``narrow`` leaves, with their scores.

    ``narrow`` gets partial scores and what is still to come at least and at most,
    and says which rows stay.
    """
    rows = np.flatnonzero(alive)
    ends = [anchor.astype(float) * block.least, anchor.astype(float) * block.most]
    if np.maximum(*map(np.abs, ends)).sum() >= _EXACT:
        whole = [sum(int(a) * int(x) for a, x in zip(anchor, block.columns[:, r])) for r in rows]
        scores = np.array([min(max(s, _LONG[0]), _LONG[1]) for s in whole], dtype=object)
        left = np.array(narrow(scores, 0, 0), dtype=bool)
        return rows[left], scores[left]
    order = np.argsort(-np.abs(anchor.astype(float)), kind="stable")
    rest_low = np.append(np.minimum(*ends)[order][::-1].cumsum()[::-1], 0.0)
    rest_high = np.append(np.maximum(*ends)[order][::-1].cumsum()[::-1], 0.0)
    partial = np.zeros(len(rows))
    at = 0
    while True:
        left = narrow(partial, rest_low[at], rest_high[at])
        rows, partial = rows[left], partial[left]
        if at == len(order) or not len(rows):
            return rows, partial
        some = order[at : at + _STEP]
        read = block.columns[some] if len(rows) == len(alive) else block.columns[np.ix_(some, rows)]
        partial = partial + anchor[some].astype(float) @ read.astype(float)
        at += len(some)


def _best(rows: np.ndarray, scores: np.ndarray, block: Block, most: int) -> list[tuple[int, int | None]]:
    """(score, key) of the first few: score falling, key rising, null key last."""
    found = sorted(zip((-int(s) for s in scores), block.nulls[rows].tolist(), block.keys[rows].tolist()))
    return [(-score, None if null else key) for score, null, key in found[:most]]


def positives(anchor: np.ndarray, block: Block, alive: np.ndarray, most: int) -> list[tuple[int, int | None]]:
    def narrow(partial: np.ndarray, low: float, high: float) -> np.ndarray:
        if len(partial) <= most:
            return np.ones(len(partial), bool)
        bar = np.partition(partial, len(partial) - most)[len(partial) - most]
        return partial + high >= bar + low

    return _best(*scan(anchor, block, alive, narrow), block, most)


def negatives(
    anchor: np.ndarray, block: Block, alive: np.ndarray, windows: list[tuple[int, int]], most: int
) -> list[list[tuple[int, int | None]]]:
    """Per window (least, greatest score) the best few rows in it."""

    def narrow(partial: np.ndarray, low: float, high: float) -> np.ndarray:
        stay = np.zeros(len(partial), bool)
        least, greatest = partial + low, partial + high
        for bottom, top in windows:
            # So many rows are in the window for sure: what stays below them is out.
            inside = least[(least >= bottom) & (greatest <= top)]
            if len(inside) >= most:
                bottom = max(bottom, np.partition(inside, len(inside) - most)[len(inside) - most])
            stay |= ((greatest >= bottom) & (least <= top)).astype(bool)
        return stay

    rows, scores = scan(anchor, block, alive, narrow)
    out = []
    for bottom, top in windows:
        inside = ((scores >= bottom) & (scores <= top)).astype(bool)
        out.append(_best(rows[inside], scores[inside], block, most))
    return out


def window(positive: int, spec: NegativeSpec) -> tuple[int, int]:
    """Least and greatest whole score of a negative; empty if the first is above the second."""
    return -(-spec.low * positive // 100), spec.high * positive // 100


def _packed(rows: DataFrame, most: int, label: str) -> DataFrame:
    """Blocks of the rows in order of (length, label, key), numbered from 0 within a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            keys = pa.concat_arrays([k for k, _, _ in held])
            labels = np.concatenate([x for _, x, _ in held])
            matrix = np.ascontiguousarray(np.concatenate([m for _, _, m in held]).T)
            short = bool(matrix.size == 0 or (matrix.min() >= -(1 << 15) and matrix.max() < 1 << 15))
            data = matrix.astype(np.int16 if short else np.int64).tobytes()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([len(matrix)], pa.int64()), pa.array([keys.to_pylist()], pa.list_(pa.int64())),
                    pa.array([labels.tolist()], pa.list_(pa.int64())), pa.array([data], pa.binary()), pa.array([short]),
                ],
                names=["d", "keys", "labels", "matrix", "short"],
            )

        for batch in batches:
            lengths = np.asarray(batch.column("d"))
            values = np.asarray(batch.column("v").flatten())
            starts = np.concatenate([[0], np.cumsum(lengths)])
            at = 0
            while at < len(lengths):
                d = int(lengths[at])
                if held and held[0][2].shape[1] != d:
                    yield block()
                room = most - sum(len(m) for _, _, m in held)
                end = at + 1
                while end < len(lengths) and lengths[end] == d and end - at < room:
                    end += 1
                matrix = values[starts[at] : starts[end]].reshape(end - at, d)
                held.append((batch.column("key").slice(at, end - at), np.asarray(batch.column("label"))[at:end], matrix))
                at = end
                if sum(len(m) for _, _, m in held) == most:
                    yield block()
        if held:
            yield block()

    order = ["d", "label", F.col("key").asc_nulls_last(), F.xxhash64("v")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = dealt.mapInArrow(run, _BLOCK)
    # Staged with their ids, so that the numbers drawn from them hold whatever is computed again.
    blocks = stage(blocks.withColumn("at", F.monotonically_increasing_id()), label)
    number = F.row_number().over(Window.partitionBy("d").orderBy("at")) - 1
    return blocks.join(blocks.select("d", "at", number.alias("no")), ["d", "at"]).drop("at")


def _cells(anchors: DataFrame, blocks: DataFrame, pairs: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` on each (length, anchor block, row block) of ``pairs``, one group per cell."""
    left = anchors.withColumnRenamed("no", "a").join(pairs, ["d", "a"])
    right = blocks.withColumnRenamed("no", "b").join(pairs, ["d", "b"])
    return left.groupBy("d", "a", "b").cogroup(right.groupBy("d", "a", "b")).applyInArrow(run, schema)


def _best_positives(spec: NegativeSpec) -> Callable:
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, block = Block.of(left), Block.of(right)
        out = []
        for i, (own, label) in enumerate(zip(anchors.keys, anchors.labels)):
            alive = (block.labels == label) & ((block.keys != own) | block.nulls)
            if alive.any():
                found = positives(anchors.columns[:, i], block, alive, spec.positives)
                out += [(key[0].as_py(), key[1].as_py(), i, int(own), score, k) for score, k in found]
        return _rows(out, ["d", "a", "i", "anchor", "score", "key"])

    return run


def _best_negatives(spec: NegativeSpec) -> Callable:
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        anchors, block = Block.of(left), Block.of(right)
        scores: dict[int, set[int]] = {}
        for asked in left.column("asked")[0].as_py():
            scores.setdefault(asked["i"], set()).add(asked["score"])
        out = []
        for i, asked in scores.items():
            wanted = [(s, *window(s, spec)) for s in sorted(asked)]
            wanted = [w for w in wanted if w[1] <= w[2]]
            alive = (block.labels != anchors.labels[i]) & ((block.keys != anchors.keys[i]) | block.nulls)
            if not wanted or not alive.any():
                continue
            found = negatives(anchors.columns[:, i], block, alive, [w[1:] for w in wanted], spec.negatives)
            for (s, _, _), best in zip(wanted, found):
                out += [(key[0].as_py(), key[1].as_py(), i, s, score, k) for score, k in best]
        return _rows(out, ["d", "a", "i", "positive_score", "negative_score", "negative_id"])

    return run


def _rows(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def mine(
    vectors: DataFrame, key: str, vector: str, label: str, anchor: Column, spec: NegativeSpec = NegativeSpec()
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``key`` and ``label`` are integers; rows where ``anchor`` holds are anchors too.
    """
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(key).cast("long").alias("key"),
        F.col(label).cast("long").alias("label"),
        F.transform(values, lambda x: F.floor(x * spec.scale)).alias("v"),
        F.coalesce(anchor & F.col(key).isNotNull(), F.lit(False)).alias("anchor"),
    )
    rows = rows.groupBy("key", "label", "v").agg(F.max("anchor").alias("anchor")).withColumn("d", F.size("v"))
    rows = stage(rows.withColumn("d", F.col("d").cast("long")), "vectors")
    blocks = _packed(rows.drop("anchor"), spec.block, "blocks")
    anchors = _packed(rows.where("anchor").drop("anchor"), spec.anchors, "anchors")

    def held(blocks: DataFrame, name: str) -> DataFrame:
        return blocks.select("d", F.col("no").alias(name), F.explode(F.array_distinct("labels")).alias("label"))

    alike = held(anchors, "a").join(held(blocks, "b"), ["d", "label"]).select("d", "a", "b").distinct()
    found = _cells(
        anchors, blocks, alike, _best_positives(spec), "d long, a long, i long, anchor long, score long, key long"
    )
    first = Window.partitionBy("d", "a", "i").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    best = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= spec.positives)
    best = stage(best, "positives")

    asked = best.groupBy("d", "a").agg(F.collect_set(F.struct("i", "score")).alias("asked"))
    rounds = anchors.groupBy("d").agg(F.max("no").alias("last"))
    every = blocks.select("d", F.col("no").alias("b")).join(rounds, "d")
    every = every.select("d", "b", F.explode(F.sequence(F.lit(0), "last")).alias("a"))
    asking = anchors.join(asked.withColumnRenamed("a", "no"), ["d", "no"])
    mined = _cells(
        asking, blocks, every, _best_negatives(spec),
        "d long, a long, i long, positive_score long, negative_score long, negative_id long",
    )
    order = [F.desc("negative_score"), F.col("negative_id").asc_nulls_last()]
    first = Window.partitionBy("d", "a", "i", "positive_score").orderBy(*order)
    mined = mined.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= spec.negatives)
    asked_by = best.select(
        "d", "a", "i", F.col("anchor").alias("anchor_id"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return asked_by.join(mined, ["d", "a", "i", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
