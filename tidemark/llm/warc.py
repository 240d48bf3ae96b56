"""Web archives: a deterministic sharded writer and a reader.

Rows are cut into shards by ranges of the key with about ``shard_bytes`` of
payload each. The borders come from exact sums over ``cells`` equal ranges of
keys, so equal input gives equal files however it is partitioned. Within a
shard records are sorted by key; headers and digests are made anew; every
record is a gzip member of its own; a file is closed once it has
``file_bytes`` compressed. A task writes under a name of its own attempt; only
the files that the staged manifest names are then renamed, so a repeated or
speculative attempt leaves nothing behind that is read. Rename can be repeated.

Of rows with equal payloads of at least ``least`` bytes the one with the
largest key is a response, the others are revisits of it without payload.
Digests are settled on slim rows, then travel with the payloads in one shuffle.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.staging import stage


@dataclass(frozen=True)
class WarcSpec:
    least: int = 0
    shard_bytes: int = 64 << 20
    file_bytes: int = 16 << 20
    cells: int = 4096
    level: int = 6


# A fixed date, so that equal input gives equal files.
_DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, payload_digest: str, refers: str | None, refers_url: str | None) -> bytes:
    """One record; ``refers`` is the record id of the response if it is a revisit."""
    kind = "response" if refers is None else "revisit"
    length = len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers is None else b"")
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers is not None:
        uri = (refers_url or "").replace("\r", "%0D").replace("\n", "%0A")
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {refers}",
            f"WARC-Refers-To-Target-URI: {uri}",
        ]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def record_id(key: int | None) -> str:
    return f"<urn:x-page:{'' if key is None else key}>"


def _page_of(mark: str) -> int | None:
    number = mark.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def shard_borders(rows: DataFrame, key: str, size: Column, spec: WarcSpec) -> list[int]:
    """The least key of every shard but the first."""
    ends = rows.agg(F.min(key), F.max(key)).first()
    if ends[0] is None:
        return []
    low, width = ends[0], max(1, -(-(ends[1] - ends[0] + 1) // spec.cells))
    cell = F.expr(f"cast(({key} - {low}L) div {width}L as long)")
    # At most ``cells`` rows, whatever the data.
    sums = rows.where(F.col(key).isNotNull()).groupBy(cell.alias("cell")).agg(F.sum(size).alias("n")).collect()
    borders, held = [], 0
    for found in sorted(sums, key=lambda r: r["cell"]):
        if held and held + found["n"] > spec.shard_bytes:
            borders.append(low + found["cell"] * width)
            held = 0
        held += found["n"]
    return borders


def _decisions(slim: DataFrame, spec: WarcSpec) -> DataFrame:
    """(key, sha, refers, refers_url) of rows whose payload another key has too."""
    of = slim.where(F.col("size") >= spec.least).groupBy("sha").agg(
        F.max(F.struct("key", "url")).alias("last"), F.count(F.lit(1)).alias("n")
    )
    of = of.where("n > 1").select(F.col("sha").alias("_sha"), "last")
    own = slim.select("key", "sha").join(of, F.col("sha") == F.col("_sha"))
    return own.select("key", "sha", F.col("last.key").alias("refers"), F.col("last.url").alias("refers_url")).distinct()


def write(pages: DataFrame, key: str, url: str, payload: str, folder: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Writes ``pages`` as archives under ``folder``; returns the manifest
    (``name``, ``shard``, ``records``, ``bytes``), also kept there as Parquet.

    A null payload is empty. Rows without a key come first and count as smaller
    than all others. Of rows that repeat key and payload the first written is the
    response if theirs is the largest key. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(payload, F.lit("")), "UTF-8").alias("body"),
    ).withColumn("sha", F.sha1("body"))
    slim = rows.select("key", "url", "sha", F.octet_length("body").cast("long").alias("size"))
    slim = stage(slim, "digests")
    borders = shard_borders(slim, "key", F.col("size") + 512, spec)
    parts = len(borders) + 1
    limits = spark.createDataFrame([(b,) for b in borders], "border long").agg(F.sort_array(F.collect_list("border")))
    # One border per shard_bytes, as one array.
    shard = F.size(F.filter(F.col("_borders"), lambda b: b <= F.col("key"))) if parts > 1 else F.lit(0)
    decided = _decisions(slim, spec)
    laid = decided.select(
        "key", F.lit(0).alias("kind"), "sha", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("body"), "refers", "refers_url"
    ).union(
        rows.select("key", F.lit(1), "sha", "url", "body", F.lit(None).cast("long"), F.lit(None).cast("string"))
    )
    if parts > 1:
        laid = laid.withColumn("_borders", limits.scalar()).withColumn("shard", shard).drop("_borders")
    else:
        laid = laid.withColumn("shard", shard)
    laid = laid.withColumn("shard", F.coalesce("shard", F.lit(0)).cast("int"))
    laid = laid.repartitionById(parts, "shard").sortWithinPartitions("key", "kind", "sha", "url")
    manifest = stage(laid.mapInArrow(_writer(folder, spec), _MANIFEST), "manifest")
    manifest.select("temporary", "name").repartition(max(1, min(parts, 1000)), "name").mapInArrow(
        _renamer(folder), "name string"
    ).count()
    manifest = manifest.select("name", "shard", "records", "bytes")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


_MANIFEST = "name string, temporary string, shard int, records long, bytes long"


def _opened(folder: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)
    return system, path


def _writer(folder: str, spec: WarcSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(folder)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        system.create_dir(f"{path}/_temporary", recursive=True)
        made, out, shard, part = [], None, None, 0
        decisions: dict[str, tuple] = {}
        current: tuple | None = None
        used: set[str] = set()

        def close() -> None:
            nonlocal out
            if out is not None:
                out[0].close()
                made.append((out[2], out[1], shard, out[3], out[4]))
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    close()
                    shard, part = row["shard"], 0
                if current is None or row["key"] != current[0]:
                    current, decisions, used = (row["key"],), {}, set()
                if row["kind"] == 0:
                    decisions[row["sha"]] = (row["refers"], row["refers_url"])
                    continue
                refers, refers_url = decisions.get(row["sha"], (None, None))
                first = row["sha"] not in decisions or (refers == row["key"] and row["sha"] not in used)
                used.add(row["sha"])
                body = row["body"]
                raw = record(row["key"], row["url"], body, digest(body), None if first else record_id(refers), refers_url)
                packed = gzip.compress(raw, spec.level, mtime=0)
                if out is None:
                    name = f"shard-{shard:06d}-{part:05d}.warc.gz"
                    temporary = f"_temporary/{attempt}-{name}"
                    out = [system.open_output_stream(f"{path}/{temporary}", compression=None), temporary, name, 0, 0]
                    part += 1
                out[0].write(packed)
                out[3] += 1
                out[4] += len(packed)
                if out[4] >= spec.file_bytes:
                    close()
        close()
        names = ["name", "temporary", "shard", "records", "bytes"]
        yield pa.RecordBatch.from_pylist([dict(zip(names, m)) for m in made], schema=pa.schema(
            [("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64())]
        ))

    return run


def _renamer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, path = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                there = system.get_file_info(f"{path}/{row['temporary']}")
                if there.type != fs.FileType.NotFound:
                    system.move(f"{path}/{row['temporary']}", f"{path}/{row['name']}")
                elif system.get_file_info(f"{path}/{row['name']}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(row["name"])
            yield pa.RecordBatch.from_arrays([batch.column(1)], names=["name"])

    return run


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one by one."""
    rest = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            data = rest or stream.read(chunk)
            rest = b""
            if not data:
                if parts:
                    raise EOFError("the last record is cut off")
                return
            parts.append(unpack.decompress(data))
        rest = unpack.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """Headers (lower-case names) and ``block`` of one record; digests are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a record")
    found = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(found["content-length"])]
    if found["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {found['warc-record-id']}")
    return found | {"block": block}


def read(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records of the files in ``manifest``: ``key``, ``url``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` and, if asked for, ``payload``
    (null for revisits). A task reads one record at a time."""
    spark: SparkSession = manifest.sparkSession
    files = manifest.select("name").distinct()
    wide = max(1, spark.sparkContext.defaultParallelism)
    schema = "key long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _opened(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        rows.append(_row(parse(raw), payloads))
                        held += len(raw) if payloads else 200
                        if held > 4 << 20:
                            yield _record_batch(rows, payloads)
                            rows, held = [], 0
                if rows:
                    yield _record_batch(rows, payloads)

    return files.repartition(wide, "name").mapInArrow(run, schema + ", payload binary" * payloads)


def _row(found: dict, payloads: bool) -> dict:
    head, _, body = found["block"].partition(b"\r\n\r\n")
    length = next(int(h[16:]) for h in head.split(b"\r\n") if h.lower().startswith(b"content-length: "))
    whole = found["warc-payload-digest"].removeprefix("sha1:")
    response = found["warc-type"] == "response"
    if response and (digest(body), len(body)) != (whole, length):
        raise ValueError(f"damaged payload in {found['warc-record-id']}")
    out = {
        "key": _page_of(found["warc-record-id"]),
        "url": found["warc-target-uri"],
        "payload_bytes": length,
        "payload_digest": whole,
        "record_type": found["warc-type"],
        "refers_to": None if response else _page_of(found["warc-refers-to"]),
    }
    return out | ({"payload": body if response else None} if payloads else {})


def _record_batch(rows: list[dict], payloads: bool) -> pa.RecordBatch:
    fields = [
        ("key", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields if payloads else fields[:-1]))
