"""Near-duplicate documents by an inverted join on signature coordinates.

Documents with equal shingle sets collapse to one representative first, which
has a number of its own: a key with several texts may be the least of several
sets. Every representative is posted under its (coordinate, value) pairs. A pair above the
similarity agrees in at least ``matches`` coordinates but for ``miss`` in
probability, so it shares a list among the ``coordinates - matches + 1`` rarest
pairs of either side: only these prefixes are posted, pairs that nobody shares
count as the rarest, and the long lists of shared passages are never merged.
Documents that meet in a list form a class. Classes are compared in cells of
two blocks: collisions of signatures are counted, pairs below ``matches`` are
skipped, and the others are confirmed on the full shingle sets, the likeliest
first, unless earlier links of the cell already connect them. So a cell returns
a spanning forest of true links, never all pairs, and no task holds more than
two blocks of a class. The work in a class of n different near copies is
n * n / 2 counts of collisions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.words import MinHash, byte_classes, shingles, text_blocks, word_hashes
from tidemark.sources.staging import stage


@dataclass(frozen=True)
class NearSpec:
    """Documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of ``width``-word shingles (words lower-cased in A-Z)."""

    width: int = 5
    percent: int = 80
    coordinates: int = 64
    miss: float = 1e-6
    block: int = 256
    seed: int = 11

    @property
    def matches(self) -> int:
        """The most collisions that a linked pair reaches but for ``miss``."""
        n, p = self.coordinates, self.percent / 100
        below = 0.0
        for k in range(n + 1):
            below += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if below > self.miss:
                return max(1, k)
        return n


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The set of 64-bit shingle hashes of every text, sorted."""
    classes = byte_classes()
    for _, data, starts in text_blocks(texts):
        hashes, first = word_hashes(data, starts, classes)
        for a, b in zip(first, first[1:]):
            yield np.unique(shingles(hashes[a:b], width))


def _set_key(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, key: str, text: str, spec: NearSpec) -> DataFrame:
    """(``key``, ``n_shingles``, ``set_key``, ``signature``) of every row; the
    last two are null without shingles."""
    schema = pa.schema(
        [
            ("key", pa.int64()),
            ("n_shingles", pa.int64()),
            ("set_key", pa.binary()),
            ("signature", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = MinHash(spec.coordinates, spec.seed)
        for batch in batches:
            sizes, keys, signed = [], [], []
            for members in shingle_sets(batch.column(1), spec.width):
                sizes.append(len(members))
                some = len(members) > 0
                keys.append(_set_key(members) if some else None)
                signed.append(sign(members) if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, f.type) for v, f in zip((sizes, keys, signed), list(schema)[1:]))],
                schema=schema,
            )

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "key long, n_shingles long, set_key binary, signature array<int>")


def _prefixes(reps: DataFrame, spec: NearSpec) -> DataFrame:
    """(list, rep): the postings of every representative's rarest shared pairs."""
    pair = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
    posted = reps.select("rep", F.posexplode("signature").alias("at", "value")).select("rep", pair.alias("list"))
    shared = posted.groupBy(F.col("list").alias("known")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = posted.join(shared, F.col("list") == F.col("known"))
    own = joined.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "list"))).alias("lists"))
    # Pairs of a single document come first in the order and fill the prefix.
    left = spec.coordinates - spec.matches + 1 - (spec.coordinates - F.size("lists"))
    chosen = own.where(left > 0).select("rep", F.explode(F.slice("lists", 1, left)).alias("chosen"))
    return chosen.select(F.col("chosen.list").alias("list"), "rep")


def _classes(reps: DataFrame, spec: NearSpec) -> DataFrame:
    """(class, rep, blocks): representatives that may be linked share a class."""
    postings = stage(_prefixes(reps, spec), "postings")
    first = postings.groupBy(F.col("list").alias("known")).agg(F.min("rep").alias("first"))
    stars = postings.join(first, F.col("list") == F.col("known")).where(F.col("rep") != F.col("first"))
    found = components(stars.select("rep", "first").distinct(), "rep", "first")
    members = found.union(found.select("component", "component").distinct()).toDF("rep", "class")
    sizes = members.groupBy(F.col("class").alias("known")).agg(F.ceil(F.count(F.lit(1)) / spec.block).alias("blocks"))
    return members.join(sizes, F.col("class") == F.col("known")).select("class", "rep", "blocks")


def _cells(docs: DataFrame, key: str, text: str, members: DataFrame, spec: NearSpec) -> DataFrame:
    """(class, low, high, rep, block, signature, members) for each cell a representative is compared in."""
    known = members.select("rep", F.col("least").alias("known"), "class", "blocks", "set_key")
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    texts = texts.join(known, F.col("key") == F.col("known")).select("rep", "class", "blocks", "set_key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = MinHash(spec.coordinates, spec.seed)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = list(shingle_sets(part.column(4), spec.width))
                # Another text of the same key is not the representative's.
                own = [i for i, s in enumerate(sets) if _set_key(s) == part.column(3)[i].as_py()]
                part, sets = part.take(pa.array(own, pa.int64())), [sets[i] for i in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array([sign(s).tobytes() for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["rep", "class", "blocks", "signature", "members"],
                )

    made = texts.mapInArrow(run, "rep long, class long, blocks long, signature binary, members binary")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    made = made.withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return made.withColumn("other", other).select(
        "class", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "rep", "block", "signature", "members",
    )


def _links(cells: DataFrame, spec: NearSpec) -> DataFrame:
    """(a, b): confirmed links of representatives, a spanning forest of each cell."""
    need, percent, width = spec.matches, spec.percent, spec.coordinates

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("rep").sort_values("rep", ignore_index=True)
        ids = rows["rep"].to_numpy()
        signed = np.frombuffer(b"".join(rows["signature"]), np.int32).reshape(len(ids), width)
        sets = [np.frombuffer(m, np.uint64) for m in rows["members"]]
        sizes = np.array([len(s) for s in sets])
        block = rows["block"].to_numpy()
        sides = [np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])]
        root = list(range(len(ids)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = []
        for at in range(0, len(sides[0]), 64):
            left, right = sides[0][at : at + 64], sides[1]
            same = np.zeros((len(left), len(right)), np.int16)
            for k in range(width):
                same += signed[left, k][:, None] == signed[right, k][None, :]
            small, large = np.minimum.outer(sizes[left], sizes[right]), np.maximum.outer(sizes[left], sizes[right])
            near = (same >= need) & (100 * small >= percent * large)
            if key[1] == key[2]:
                near &= left[:, None] < right[None, :]
            x, y = np.nonzero(near)
            for i in np.argsort(-same[x, y], kind="stable"):
                a, b = int(left[x[i]]), int(right[y[i]])
                if top(a) == top(b):
                    continue
                common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * common >= percent * (sizes[a] + sizes[b] - common):
                    root[top(a)] = top(b)
                    found.append((ids[a], ids[b]))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return cells.groupBy("class", "low", "high").applyInPandas(run, "a long, b long")


def near_groups(docs: DataFrame, key: str, text: str, spec: NearSpec = NearSpec()) -> DataFrame:
    """(``key``, ``n_shingles``, ``component_id``, ``kept``), one row per row of ``docs``.

    ``component_id`` is the smallest key reachable by links, itself included.
    Null, empty and blank texts have no shingles and stay alone; a row without a
    key has a null ``component_id`` and is kept. Rows with the same key count as
    one document with several texts. Texts are used whole.
    """
    signed = stage(signatures(docs, key, text, spec), "signatures")
    keyed = signed.where(F.col("key").isNotNull() & F.col("set_key").isNotNull())
    grouped = keyed.groupBy("set_key").agg(F.min("key").alias("least"), F.first("signature").alias("signature"))
    reps = stage(grouped.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    members = stage(_classes(reps.select("rep", "signature"), spec), "classes")
    members = members.join(reps.select(F.col("rep").alias("of"), "least", "set_key"), F.col("rep") == F.col("of"))
    links = _links(_cells(docs, key, text, members, spec), spec)
    joined = signed.select("key", "n_shingles", "set_key").join(
        reps.select(F.col("set_key").alias("known"), "rep", "least"), F.col("set_key") == F.col("known"), "left"
    )
    own_rep, own_least = (F.when(F.col("key").isNotNull(), F.col(c)).alias(c) for c in ("rep", "least"))
    joined = joined.select("key", "n_shingles", own_rep, own_least)
    # A key with several texts links their sets.
    several = joined.groupBy(F.col("key").alias("with")).agg(F.min("rep").alias("m"), F.max("rep").alias("n")).where("m < n")
    across = joined.join(several, F.col("key") == F.col("with")).where("rep > m").select("rep", "m")
    found = components(links.select("a", "b").union(across), "a", "b").toDF("node", "component")
    whole = found.union(found.select("component", "component").distinct())
    keys = whole.join(reps.select("rep", "least"), F.col("node") == F.col("rep"))
    keys = keys.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("linked"))
    named = whole.join(keys, F.col("component") == F.col("of")).select("node", "linked")
    placed = joined.join(named, F.col("rep") == F.col("node"), "left")
    own = F.coalesce("linked", "least", "key")
    return placed.select(
        F.col("key").alias(key), "n_shingles", own.alias("component_id"), F.col("key").eqNullSafe(own).alias("kept")
    )
