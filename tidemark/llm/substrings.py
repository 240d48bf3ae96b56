"""Removal of repeated byte strings by refined q-gram buckets.

A byte goes if a string of ``length`` bytes that covers it also starts earlier:
in a smaller document, or earlier in the same one.

Initial buckets: positions share a bucket if their ``gram`` bytes are equal.
Only anchors are bucketed: of the grams in every ``length``-byte window the one
with the lowest hash, the first of equals. Equal windows have the same anchor at
the same offset, so nothing is missed, and about one position in forty is kept.
Anchors are range-partitioned and sorted by (bucket, hash of the bytes around,
document, position), so a bucket with very many anchors is split. One pass over
the sorted rows settles most of them: an anchor whose whole surroundings occur
earlier is repeated throughout, an anchor whose bucket holds nothing else is
dropped. At the edges of a partition, where the neighbour is not seen, an anchor
is kept as undecided.

Refinement: of undecided buckets the bytes around each anchor are fetched. For
every start before the anchor, buckets of ``gram`` bytes are refined by sorting
on the bucket identifiers ``gram`` bytes later, then twice that, reusing the
identifiers just made, until they stand for ``length`` bytes; rows alone in
their bucket drop out at once. A row that is not the first of its last bucket
repeats that string. A bucket beyond ``together`` rows is not refined in its
task: its strings are hashed and grouped by a shuffle, with the same result.

Identifiers are 64-bit hashes per bucket; all passes cover whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mixed, random_words
from tidemark.sources.staging import stage


@dataclass(frozen=True)
class RepeatSpec:
    length: int = 100
    gram: int = 25
    together: int = 4096
    seed: int = 3

    def __post_init__(self) -> None:
        if self.length % self.gram or bin(self.length // self.gram).count("1") != 1:
            raise ValueError("length must be a power of two times gram")

    @property
    def reach(self) -> int:
        """Bytes a window can hold on either side of its anchor's gram."""
        return self.length - self.gram


_PIECE = 1 << 19


class _Hasher:
    """Hashes of substrings from running sums, modulo 2**64."""

    def __init__(self, seed: int):
        self.values = random_words(256, seed)
        self.base = int(random_words(1, seed + 1)[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.powers):
            size = max(n, 1 << 16)
            for name, x in (("powers", self.base), ("inverses", self.inverse)):
                row = np.full(size, x, np.uint64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=np.uint64))
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], out=out[1:])
        return out

    def parts(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[begin]) * self.inverses[begin]


def anchors(data: np.ndarray, sums: np.ndarray, hasher: _Hasher, spec: RepeatSpec) -> np.ndarray:
    """Positions of all anchors of one text, in order."""
    grams, width = len(data) - spec.gram + 1, spec.reach + 1
    found = []
    for at in range(0, grams - width + 1, _PIECE):
        begin = np.arange(at, min(at + _PIECE + width - 1, grams))
        hashed = mixed(hasher.parts(sums, begin, begin + spec.gram))
        least = (hashed & ~np.uint64((1 << 20) - 1)) | np.arange(len(begin), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: len(begin) - width + 1], least[width - span :])
        found.append(np.unique(least & np.uint64((1 << 20) - 1)).astype(np.int64) + at)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    for text in column.cast(pa.binary()):
        yield np.frombuffer(text.as_buffer() or b"", np.uint8) if text.is_valid else np.zeros(0, np.uint8)


def _anchor_rows(docs: DataFrame, spec: RepeatSpec) -> DataFrame:
    """(bucket, around, doc, place) of all anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher(spec.seed)
        for batch in batches:
            made: list[list[np.ndarray]] = []
            held = 0
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, data in enumerate(_texts(batch.column(2))):
                if len(data) < spec.length:
                    continue
                sums = hasher.sums(data)
                at = anchors(data, sums, hasher, spec)
                low, high = np.maximum(at - spec.reach, 0), np.minimum(at + spec.length, len(data))
                around = hasher.parts(sums, low, high) + mixed((at - low) * 1024 + (high - at))
                bucket = mixed(hasher.parts(sums, at, at + spec.gram))
                place = (at << 32) | (int(marks[row]) & 0xFFFFFFFF)
                made.append([bucket.view(np.int64), mixed(around).view(np.int64), np.full(len(at), ids[row]), place])
                held += len(at)
                if held > 50_000:
                    yield _batch(made, ("bucket", "around", "doc", "place"))
                    made, held = [], 0
            if made:
                yield _batch(made, ("bucket", "around", "doc", "place"))

    return docs.select("doc", "mark", "text").mapInArrow(run, "bucket long, around long, doc long, place long")


def _batch(parts: list[list[np.ndarray]], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=list(names))


def _settle(rows: DataFrame) -> DataFrame:
    """Of sorted rows (bucket, doc, place, repeated): those repeated throughout, and the undecided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int] | None = None
        # Document and place of the first anchor with the current surroundings.
        origin = np.zeros(2, np.int64)
        # The first anchor of the current bucket, while nothing else is known in it.
        pending: tuple[int, int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, around, doc, place = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            opens = np.zeros(len(bucket), bool)
            opens[starts] = True
            new = opens.copy()
            new[1:] |= around[1:] != around[:-1]
            edge = last is None
            if not edge:
                opens[0] = bucket[0] != last[0]
                new[0] = opens[0] or around[0] != last[1]
            # Rows of one document at one position are not earlier than each other.
            run = np.cumsum(new)
            heads = np.concatenate([origin[:, None], np.stack([doc[new], place[new]])], axis=1)[:, run]
            level = ~new & (doc == heads[0]) & (place >> 32 == heads[1] >> 32)
            repeated = ~new & ~level
            # Does the bucket of a row go on with other surroundings within this batch?
            other = new & ~opens
            many = np.logical_or.reduceat(other, starts)
            undecided = other | (level & (place != heads[1]))
            undecided[starts] |= opens[starts] & many
            if edge:
                undecided[0] = True
            told = undecided | repeated
            out = [[bucket[told], doc[told], place[told], repeated[told]]]
            if pending is not None and not opens[0] and many[0]:
                out.append([np.array([x]) for x in pending] + [np.array([False])])
            if opens[0] or many[0] or len(starts) > 1:
                pending = None
            head = starts[-1]
            if opens[head] and not many[-1] and not (edge and head == 0):
                pending = (bucket[head], doc[head], place[head])
            last, origin = (bucket[-1], around[-1]), heads[:, -1]
            yield _batch(out, ("bucket", "doc", "place", "repeated"))
        if pending is not None:
            yield _batch([[np.array([x]) for x in pending] + [np.array([False])]], ("bucket", "doc", "place", "repeated"))

    return rows.mapInArrow(run, "bucket long, doc long, place long, repeated boolean")


def _surroundings(docs: DataFrame, undecided: DataFrame, spec: RepeatSpec) -> DataFrame:
    """(bucket, doc, place, left, bytes) of undecided anchors."""
    wanted = undecided.groupBy(
        F.col("doc").alias("_doc"), F.col("place").bitwiseAND(0xFFFFFFFF).alias("_mark")
    ).agg(F.collect_list(F.struct("bucket", "place")).alias("wanted"))
    joined = docs.join(wanted, (F.col("doc") == F.col("_doc")) & (F.col("mark") == F.col("_mark")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, held = [], 0
            for doc, wanted, data in zip(batch.column(0).to_pylist(), batch.column(1), _texts(batch.column(2))):
                raw = data.tobytes()
                buckets = wanted.values.field("bucket").to_numpy()
                places = wanted.values.field("place").to_numpy()
                at = places >> 32
                low = np.maximum(at - spec.reach, 0)
                made.append(
                    (buckets, np.full(len(at), doc), places, at - low, [raw[a : b + spec.length] for a, b in zip(low, at)])
                )
                held += len(at)
                if held > 20_000:
                    yield _flat(made)
                    made, held = [], 0
            if made:
                yield _flat(made)

    return joined.select("doc", "wanted", "text").mapInArrow(
        run, "bucket long, doc long, place long, left long, bytes binary"
    )


def _flat(made: list[tuple]) -> pa.RecordBatch:
    *numbers, texts = zip(*made)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.concatenate(c)) for c in numbers), pa.array([x for part in texts for x in part], pa.binary())],
        names=["bucket", "doc", "place", "left", "bytes"],
    )


def _refined(bucket: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of (bucket, later bucket) pairs; -1 for rows alone in theirs."""
    out = np.full(len(bucket), -1, np.int64)
    live = np.flatnonzero((bucket >= 0) & (later >= 0))
    if len(live) < 2:
        return out
    order = live[np.lexsort((later[live], bucket[live]))]
    b, c = bucket[order], later[order]
    new = np.append(True, (b[1:] != b[:-1]) | (c[1:] != c[:-1]))
    ids = np.cumsum(new) - 1
    out[order] = np.where(np.bincount(ids)[ids] > 1, ids, -1)
    return out


def _grid(left: np.ndarray, texts: list[bytes], spec: RepeatSpec) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out with their anchors in one column, and which cells hold a byte."""
    width = spec.reach + spec.length
    sizes = np.array([len(t) for t in texts])
    begin = spec.reach - left
    cols = np.arange(width)
    held = (cols >= begin[:, None]) & (cols < (begin + sizes)[:, None])
    grid = np.zeros((len(texts), width), np.uint8)
    grid[held] = np.frombuffer(b"".join(texts), np.uint8)
    return grid, held


def _gram_hashes(grid: np.ndarray, held: np.ndarray, hasher: _Hasher, spec: RepeatSpec) -> tuple[np.ndarray, np.ndarray]:
    """Per column the hash of the gram that starts there, and whether all its bytes are there."""
    width, n = grid.shape[1], spec.gram
    hasher.sums(np.zeros(width, np.uint8))
    sums = np.zeros((len(grid), width + 1), np.uint64)
    np.cumsum(hasher.values[grid] * hasher.powers[:width], axis=1, out=sums[:, 1:])
    hashed = (sums[:, n:] - sums[:, :-n]) * hasher.inverses[: width - n + 1]
    return hashed, held[:, n - 1 :] & held[:, : width - n + 1]


def _repeats(
    bucket: np.ndarray, doc: np.ndarray, at: np.ndarray, left: np.ndarray, texts: list[bytes], hasher: _Hasher, spec: RepeatSpec
) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in document order: the repeated bytes, from and to relative to the anchor (to 0: none)."""
    hashed, full = _gram_hashes(*_grid(left, texts, spec), hasher, spec)
    initial: dict[int, np.ndarray] = {}

    def grams(c: int) -> np.ndarray:
        """Initial buckets of the grams in a column."""
        if c not in initial:
            initial[c] = _refined(np.where(full[:, c], bucket, -1), hashed[:, c].view(np.int64) & 0x7FFFFFFFFFFFFFFF)
        return initial[c]

    known: dict[tuple[int, int], np.ndarray] = {}

    def ids(c: int, size: int) -> np.ndarray:
        if size == spec.gram:
            return grams(c)
        if (c, size) not in known:
            known[c, size] = _refined(ids(c, size // 2), ids(c + size // 2, size // 2))
        return known[c, size]

    start = np.full(len(bucket), spec.length, np.int64)
    end = np.zeros(len(bucket), np.int64)
    for c in range(spec.reach + 1):
        found = ids(c, spec.length)
        rows = np.flatnonzero(found >= 0)
        if len(rows):
            _, opens, group = np.unique(found[rows], return_index=True, return_inverse=True)
            first_of = rows[opens][group]
            again = rows[(doc[rows] != doc[first_of]) | (at[rows] != at[first_of])]
            start[again] = np.minimum(start[again], c - spec.reach)
            end[again] = c - spec.reach + spec.length
    return start, end


_SPAN = "doc long, mark long, begin long, end long, bucket long, string long"


def _spans(around: DataFrame, spec: RepeatSpec) -> DataFrame:
    """Repeated spans of undecided anchors; of a bucket beyond ``together`` rows
    all its strings instead (``string`` not null), one row each."""
    names = ["doc", "mark", "begin", "end", "bucket", "string"]

    def solved(rows: pa.Table, hasher: _Hasher) -> pa.RecordBatch:
        bucket, doc, place, left = (rows.column(i).to_numpy() for i in range(4))
        _, dense = np.unique(bucket, return_inverse=True)
        start, end = _repeats(dense.astype(np.int64), doc, place >> 32, left, rows.column(4).to_pylist(), hasher, spec)
        some = end > 0
        at = place[some] >> 32
        empty = pa.nulls(int(some.sum()), pa.int64())
        columns = [doc[some], place[some] & 0xFFFFFFFF, at + start[some], at + end[some]]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), empty, empty], names=names)

    def strings(rows: pa.Table, hasher: _Hasher) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, 1024):
            part = rows.slice(at, 1024)
            bucket, doc, place, left = (part.column(i).to_numpy() for i in range(4))
            hashed, full = _gram_hashes(*_grid(left, part.column(4).to_pylist(), spec), hasher, spec)
            for c in range(spec.reach + 1):
                cols = range(c, c + spec.length, spec.gram)
                live = np.logical_and.reduce([full[:, k] for k in cols])
                total = np.full(int(live.sum()), c, np.uint64)
                for k in cols:
                    total = mixed(total + hashed[live, k])
                begin = (place[live] >> 32) + c - spec.reach
                columns = [doc[live], place[live] & 0xFFFFFFFF, begin, begin + spec.length, bucket[live]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(total.view(np.int64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher(spec.seed)
        held: pa.Table | None = None
        large: int | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if large is not None:
                same = int(np.searchsorted(rows.column(0).to_numpy(), large, "right"))
                yield from strings(rows.slice(0, same).combine_chunks(), hasher)
                rows = rows.slice(same)
                if not rows.num_rows:
                    continue
                large = None
            held = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
            while held.num_rows > spec.together:
                bucket = held.column(0).to_numpy()
                cut = int(np.searchsorted(bucket, bucket[spec.together], "left"))
                if cut:
                    yield solved(held.slice(0, cut), hasher)
                    held = held.slice(cut)
                    continue
                upto = int(np.searchsorted(bucket, bucket[0], "right"))
                yield from strings(held.slice(0, upto), hasher)
                if upto == held.num_rows:
                    large = int(bucket[0])
                held = held.slice(upto)
        if held is not None and held.num_rows:
            yield solved(held, hasher)

    return around.mapInArrow(run, _SPAN)


def _grouped(strings: DataFrame) -> DataFrame:
    """Spans of strings that are not the first of theirs."""
    least = strings.groupBy(F.col("bucket").alias("_b"), F.col("string").alias("_s")).agg(
        F.min(F.struct("doc", "begin")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    least = least.where("n > 1")
    joined = strings.join(least, (F.col("bucket") == F.col("_b")) & (F.col("string") == F.col("_s")))
    return joined.where(F.struct("doc", "begin") > F.col("first")).select("doc", "mark", "begin", "end")


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans as maximal runs in order."""
    order = np.argsort(begin, kind="stable")
    begin, upto = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, begin[1:] > upto[:-1]))
    return begin[new], upto[np.append(new[1:] - 1, len(upto) - 1)]


def _characters(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans shrunk to whole UTF-8 characters."""
    borders = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    low = borders[np.searchsorted(borders, low, "left")]
    high = borders[np.searchsorted(borders, high, "right") - 1]
    some = low < high
    return low[some], high[some]


def repeated_spans(docs: DataFrame, spec: RepeatSpec) -> DataFrame:
    """(doc, mark, begin, end) spans of repeated bytes, overlapping, of rows (doc, mark, text)."""
    rows = _anchor_rows(docs, spec)
    keys = ["bucket", "around", "doc", "place"]
    found = stage(_settle(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)), "anchors")
    at, mark = F.shiftright("place", 32), F.col("place").bitwiseAND(0xFFFFFFFF)
    whole = found.where("repeated").select(
        "doc", mark.alias("mark"), F.greatest(at - spec.reach, F.lit(0)).alias("begin"), (at + spec.length).alias("end")
    )
    around = _surroundings(docs, found.where("not repeated"), spec)
    around = around.repartition("bucket").sortWithinPartitions("bucket", "doc", "place")
    solved = stage(_spans(around, spec), "spans")
    parts = solved.where("string is null").select("doc", "mark", "begin", "end")
    return whole.union(parts).union(_grouped(solved.where("string is not null")))


def marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows as (doc, mark, text): null keys come last, the mark tells texts of one key apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.crc32(body).alias("mark"), body.alias("text")
    )


def remove_repeats(
    docs: DataFrame, key: str, text: str, spec: RepeatSpec = RepeatSpec(), whole_characters: bool = False
) -> DataFrame:
    """All columns of ``docs`` and ``kept`` (the remaining bytes), ``n_bytes``,
    ``n_removed`` and ``n_spans`` (maximal removed runs).

    Null texts are empty; texts shorter than ``length`` keep all bytes. Rows that
    share a key are one document whose texts overlap: of two equal strings at the
    same place neither is earlier, so repeated rows keep what their first copy
    keeps. Rows without a key come after all others, as one document. With
    ``whole_characters`` a character is only removed if all its bytes are.
    """
    rows = docs.withColumns(
        {
            "_doc": F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)),
            "_mark": F.crc32(F.coalesce(F.col(text), F.lit(""))),
        }
    )
    spans = repeated_spans(marked(docs, key, text), spec)
    spans = spans.groupBy(F.col("doc").alias("_d"), F.col("mark").alias("_m")).agg(
        F.collect_list("begin").alias("_begin"), F.collect_list("end").alias("_end")
    )
    joined = rows.join(spans, (F.col("_doc") == F.col("_d")) & (F.col("_mark") == F.col("_m")), "left")
    others = [c for c in docs.columns if c not in ("kept", "n_bytes", "n_removed", "n_spans")]
    place = {f.name: f for f in docs.schema.fields}
    out = [f"`{c}` {place[c].dataType.simpleString()}" for c in others]
    schema = ", ".join([*out, "kept binary", "n_bytes long", "n_removed long", "n_spans long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, runs = [], [], [], []
            begins, ends = batch.column(len(others) + 1), batch.column(len(others) + 2)
            for data, b, e in zip(_texts(batch.column(len(others))), begins, ends):
                sizes.append(len(data))
                if not b.is_valid:
                    kept.append(data.tobytes())
                    removed.append(0)
                    runs.append(0)
                    continue
                low, high = _merged(b.values.to_numpy(), np.minimum(e.values.to_numpy(), len(data)))
                if whole_characters:
                    low, high = _characters(data, low, high)
                change = np.zeros(len(data) + 1, np.int8)
                change[low] += 1
                change[high] -= 1
                kept.append(data[np.cumsum(change[:-1], dtype=np.int8) == 0].tobytes())
                removed.append(int((high - low).sum()))
                runs.append(len(low))
            made = [pa.array(kept, pa.binary()), *(pa.array(v, pa.int64()) for v in (sizes, removed, runs))]
            names = [*others, "kept", "n_bytes", "n_removed", "n_spans"]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *made], names=names)

    return joined.select(*others, F.col(text).alias("_text"), "_begin", "_end").mapInArrow(run, schema)


