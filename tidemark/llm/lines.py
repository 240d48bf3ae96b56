r"""Removal of repeated lines by levelled sorted runs of line hashes.

A line's key is the line without ``[\x20\x09-\x0D]`` at both ends and with A-Z
lower-cased; keys of fewer than ``min_chars`` code points are never dropped. The
runs hold one row per key hash (two 64-bit hashes): documents, lines, and the
document that keeps the line. Documents arrive in batches of falling keys. A
batch's hashes are merge-anti-joined to all runs: a hash that no run holds is
new, and the batch's greatest document becomes its keeper; a known hash only
adds to the counts. Then the batch is written as a run of its own. ``fan_out``
runs of one level are merged into one of the next, so a batch meets
``fan_out`` runs a level at most, and levels grow with the logarithm.

A run is a bucketed and sorted Parquet table: a batch is shuffled once, and runs
are joined and merged in pairs as they lie. A manifest names the runs that count; it is written after the run it
adds, so a job that died goes on after its last batch.

Defined cases. Null or empty text: one empty line. Null document key: the least
document. Rows of one document key count as one document, equal rows included;
each row is cut on its own. Ties: none, the greatest document key keeps all its
lines. Empty table: no rows. All lines dropped: the empty text. Other columns,
whatever their names, come back in the struct ``row``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import split_join
from tidemark.sources.staging import fresh_path, pinned

BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASH = ["h1", "h2"]


@dataclass(frozen=True)
class LineSpec:
    min_chars: int = 40
    min_docs: int = 5
    batches: int = 4
    fan_out: int = 2


class LineRuns:
    """Sorted runs of (h1, h2, docs, lines, keeper) under ``folder``.

    Opened again on the same folder and bucket count, it goes on from the last
    manifest; the runs of batches that never reached a manifest are ignored.
    """

    def __init__(self, spark: SparkSession, folder: str, fan_out: int = 2, buckets: int | None = None):
        self.spark, self.folder, self.fan_out = spark, folder, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.version, self.levels, self.done = self._last_manifest()

    def add(self, batch: DataFrame, name: str) -> None:
        """Adds (h1, h2, docs, lines, keeper), unique by hash; a ``name`` added before changes nothing."""
        if name in self.done:
            return
        dealt = batch.repartition(self.buckets, *_HASH)
        for i, run in enumerate(self.runs()):
            seen = self._open(run).select(*_HASH, F.lit(True).alias(f"_in{i}"))
            dealt = dealt.join(seen.hint("merge"), _HASH, "left")
        marks = [c for c in dealt.columns if c.startswith("_in")]
        known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in marks], F.lit(False))
        rows = dealt.select(*_HASH, "docs", "lines", F.when(~known, F.col("keeper")).alias("keeper"))
        self.levels.setdefault(0, []).append(self._write(rows))
        self.done.append(name)
        self._commit()
        level = 0
        while len(self.levels.get(level, [])) >= self.fan_out:
            old = self.levels.pop(level)
            self.levels.setdefault(level + 1, []).append(self._write(self._merged(old)))
            self._commit()
            self._drop(old)
            level += 1

    def merged(self) -> DataFrame:
        """One row per hash over all runs."""
        return self._merged(self.runs())

    def runs(self) -> list[str]:
        return [run for level in sorted(self.levels) for run in self.levels[level]]

    def remove(self) -> None:
        """Drops all runs; frames built on them cannot be read afterwards."""
        self._drop(self.runs())
        self.levels = {}

    def _merged(self, runs: list[str]) -> DataFrame:
        """Runs of unique hashes, merged as they lie by full merge joins. (A union of
        bucketed scans claims a partitioning that columnar scans do not keep.)"""

        def merge(left: DataFrame, right: DataFrame) -> DataFrame:
            both = left.join(right.toDF(*_HASH, "_docs", "_lines", "_keeper").hint("merge"), _HASH, "full")
            return both.select(
                *_HASH,
                *[(F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("docs", "lines")],
                F.coalesce("keeper", "_keeper").alias("keeper"),
            )

        return reduce(merge, [self._open(r) for r in runs])

    def _write(self, rows: DataFrame) -> str:
        run = f"tidemark_run_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, *_HASH).sortBy(*_HASH)
        writer.option("path", f"{self.folder}/{run}").saveAsTable(run)
        return run

    def _open(self, run: str) -> DataFrame:
        if not self.spark.catalog.tableExists(run):
            schema = self.spark.read.parquet(f"{self.folder}/{run}").schema
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {run} ({columns}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{run}'"
            )
        return self.spark.table(run)

    def _drop(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
            path = self._path(f"{self.folder}/{run}")
            self._files(path).delete(path, True)

    def _commit(self) -> None:
        """The manifest of a version appears whole, by a rename."""
        self.version += 1
        text = json.dumps({"levels": self.levels, "done": self.done})
        draft = self._path(f"{self.folder}/_draft-{uuid.uuid4().hex}")
        files = self._files(draft)
        out = files.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        named = self._path(f"{self.folder}/manifest-{self.version:08d}")
        if not files.rename(draft, named):
            raise RuntimeError(f"{named.toString()} was written by another job")

    def _last_manifest(self) -> tuple[int, dict[int, list[str]], list[str]]:
        root = self._path(self.folder)
        files = self._files(root)
        files.mkdirs(root)
        names = [s.getPath().getName() for s in files.listStatus(root)]
        last = max((n for n in names if n.startswith("manifest-")), default=None)
        if last is None:
            return 0, {}, []
        state = json.loads(self.spark.read.text(f"{self.folder}/{last}", wholetext=True).first()[0])
        return int(last.rpartition("-")[2]), {int(k): v for k, v in state["levels"].items()}, state["done"]

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _UPPER.lower())


def hashed_lines(docs: DataFrame, spec: LineSpec) -> DataFrame:
    """(doc, t1, t2, pos, h1, h2): the lines long enough to count of (doc, t1, t2, lines)."""
    each = docs.select("doc", "t1", "t2", F.posexplode("lines").alias("pos", "line"))
    # Lower-casing A-Z keeps the number of code points, so the length is tested first.
    trimmed = each.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.length("line") >= spec.min_chars)
    key = line_key(F.col("line"))
    return trimmed.select("doc", "t1", "t2", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def drop_repeated_lines(df: DataFrame, key: str, text: str, spec: LineSpec = LineSpec()) -> DataFrame:
    """(``key``, n_lines, n_dropped, kept, row): the text without the lines whose
    key at least ``min_docs`` documents hold, except in the greatest of them.

    ``key`` is numeric; ``row`` holds the other columns.
    """
    spark = df.sparkSession
    others = [c for c in df.columns if c not in (key, text)]
    body = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(
        F.col(key).alias("doc"),
        F.xxhash64(body).alias("t1"),
        F.xxhash64(F.lit(1), body).alias("t2"),
        F.split(body, "\n", -1).alias("lines"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row") if others else F.lit(None).cast("struct<>").alias("row"),
    )
    # Where the batches are cut has no influence on the rows, only on their sizes.
    shares = [i / spec.batches for i in range(spec.batches - 1, 0, -1)]
    cuts = (df.agg(F.percentile_approx(key, shares, 1000)).first()[0] or []) if shares else []
    batch = reduce(lambda n, cut: n + (F.coalesce(F.col("doc"), F.lit(cut)) <= cut).cast("int"), cuts, F.lit(0))
    path = fresh_path(spark, "lines")
    hashed_lines(docs.drop("row"), spec).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = "doc bigint, t1 bigint, t2 bigint, pos int, h1 bigint, h2 bigint, batch int".replace(
        "doc bigint", f"doc {df.schema[key].dataType.simpleString()}"
    )
    lines = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark, fresh_path(spark, "runs"), spec.fan_out)
    for i in range(len(cuts) + 1):
        held = lines.where(F.col("batch") == i).groupBy(*_HASH, "doc").agg(F.count(F.lit(1)).alias("lines"))
        runs.add(
            held.groupBy(*_HASH).agg(
                F.count(F.lit(1)).alias("docs"), F.sum("lines").alias("lines"), F.max("doc").alias("keeper")
            ),
            f"batch {i}",
        )
    common = pinned(runs.merged().where(F.col("docs") >= spec.min_docs).drop("docs"))
    runs.remove()
    gone = split_join(lines.drop("batch"), common, _HASH, "lines").where(~F.col("doc").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("doc", "t1", "t2").agg(F.collect_set("pos").alias("gone"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("doc", "t1", "t2")]
    both = docs.alias("d").join(gone.alias("g"), reduce(lambda a, b: a & b, same), "left")
    lines_left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.transform(lines_left, lambda i: F.get(F.col("lines"), i))
    )
    return both.select(
        F.col("d.doc").alias(key),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
        "row",
    )
