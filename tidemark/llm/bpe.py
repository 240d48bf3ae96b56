"""Byte-pair encoding and decoding with a given vocabulary.

A text is split at special tokens and then into words. A word is held as one
contiguous array of parts, each between two boundaries, with the rank of every
adjacent pair: the lowest rank is searched, the boundary inside that pair deleted
and the two neighbouring ranks refreshed, until no pair has a rank. Repeated minimum search is quadratic
in the word length, so words beyond ``SHORT_WORD`` bytes keep the same pairs in
a heap; both give the same parts. Encoded words are remembered per Python
worker as the bytes of their ids, which a text's words then join without a step
per id. At ``WORDS_KEPT`` words the table becomes the older of two, from which a
word that comes again is taken over; so frequent words outlive the rare ones.

Texts within the basic plane are split by the standard library's expressions over
listed classes, all others by the ``regex`` package; both give the same words.

The vocabulary file is read on the driver and broadcast; its size is checked
against ``MOST_BYTES``, it does not grow with the data.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHORT_WORD = 128
WORDS_KEPT = 200_000
MOST_BYTES = 64 << 20
_PIECE = 2 << 20

# The published word pattern of this vocabulary family.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Code points that Unicode 16 leaves unassigned; newer tables call them letters or numbers.
_UNASSIGNED = (
    "՘֋֌࢏౜೜₏₝-₟꟎꟏꟒꟔꟝꟢꟱꭬꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f"
)

_NO_RANK = 1 << 60
_ID_BITS = 24
_ID_MASK = (1 << _ID_BITS) - 1
_ID_BYTES = array("i").itemsize
_ASTRAL = "\U00010000"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes single texts."""

    def __init__(self, raw: bytes):
        content = json.loads(raw)
        letters = byte_alphabet()
        self.ids = {bytes(letters[c] for c in token): i for token, i in content["model"]["vocab"].items()}
        if len(self.ids.keys() & {bytes([b]) for b in range(256)}) < 256:
            raise ValueError("the vocabulary lacks single bytes")
        if max(self.ids.values()) > _ID_MASK:
            raise ValueError(f"token ids beyond {_ID_MASK}")
        self.single = [self.ids[bytes([b])] for b in range(256)]
        # Pairs of part ids to their rank, with the id of the joined part in the low bits.
        self.ranks = {}
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = (bytes(letters[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            self.ranks[self.ids[left] << _ID_BITS | self.ids[right]] = rank << _ID_BITS | self.ids[left + right]
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens") or []}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        tokens = [b""] * size
        for token, i in [*self.ids.items(), *((t.encode(), i) for t, i in self.special.items())]:
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._words = regex.compile(_WORDS)
        self._basic = _basic_words()
        astral = f"{_ASTRAL}-{chr(0x10FFFF)}"
        self._beyond = re.compile(f"[{re.split(f'[{astral}]', _UNASSIGNED, maxsplit=1)[0]}{astral}]")
        self._newer = re.compile(f"[{_UNASSIGNED}]")
        strict = _WORDS.replace(r" ?\p{L}+", rf" ?[\p{{L}}--[{_UNASSIGNED}]]+")
        strict = strict.replace(r" ?\p{N}+", rf" ?[\p{{N}}--[{_UNASSIGNED}]]+")
        self._strict = strict.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{_UNASSIGNED}])+")
        longest = sorted(self.special, key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self._known = _Known(self)

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit numbers in the machine's byte order."""
        if self._cut is None or not self._cut.search(text):
            return self._plain(text)
        parts = [p for p in self._cut.split(text) if p]
        return b"".join(_packed((self.special[p],)) if p in self.special else self._plain(p) for p in parts)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._known.__getitem__, self.words(text)))

    def words(self, text: str) -> list[str]:
        if text.isascii() or not self._beyond.search(text):
            return self._basic.findall(text)
        pattern = self._words
        if self._newer.search(text):
            pattern = regex.compile(self._strict, regex.V1)
        return pattern.findall(text)

    def word_ids(self, word: bytes) -> tuple[int, ...]:
        return tuple(self._merged(word) if len(word) <= SHORT_WORD else self._merged_long(word))

    def _merged(self, word: bytes) -> list[int]:
        """Boundaries are held as the ids of the parts between them."""
        rank_of = self.ranks.get
        parts = [self.single[b] for b in word]
        ranks = [rank_of(a << _ID_BITS | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == _NO_RANK:
                break
            i = ranks.index(lowest)
            joined = parts[i] = lowest & _ID_MASK
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << _ID_BITS | joined, _NO_RANK)
            if i < len(ranks):
                ranks[i] = rank_of(joined << _ID_BITS | parts[i + 1], _NO_RANK)
        return parts

    def _merged_long(self, word: bytes) -> list[int]:
        rank_of = self.ranks.get
        n = len(word)
        parts = [self.single[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            if a >= 0 and after[a] < n:
                b = after[a]
                rank = rank_of(parts[a] << _ID_BITS | parts[b])
                if rank is not None:
                    heapq.heappush(waiting, (rank, a, parts[a], parts[b]))

        for a in range(n - 1):
            offer(a)
        while waiting:
            rank, a, left, right = heapq.heappop(waiting)
            b = after[a]
            # A part that was joined to its left has no id any more.
            if parts[a] != left or b >= n or parts[b] != right:
                continue
            parts[a], parts[b], after[a] = rank & _ID_MASK, -1, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            offer(before[a])
        return [p for p in parts if p >= 0]

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.lengths))]
        lengths = self.lengths[ids]
        total = int(lengths.sum())
        shift = np.repeat(self.begins[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.bytes[shift + np.arange(total)].tobytes().decode("utf-8", "replace")


def _packed(ids: Iterable[int]) -> bytes:
    return array("i", ids).tobytes()


def _basic_words() -> re.Pattern[str]:
    """``_WORDS`` for the basic plane, with the classes of the ``regex`` package listed."""
    plane = "".join(map(chr, range(ord(_ASTRAL))))
    listed = {c: _ranges(regex.findall(c, plane)) for c in (r"\p{L}", r"\p{N}", r"\s")}
    letter, number, space = listed.values()
    return re.compile(
        rf"""'(?:[stmd]|re|ve|ll)| ?(?:[{letter}]+|[{number}]+|[^{space}{letter}{number}]+)|[{space}]+(?![^{space}])|[{space}]+"""
    )


def _ranges(characters: list[str]) -> str:
    """Sorted characters as the inside of a class."""
    found: list[list[int]] = []
    for code in map(ord, characters):
        if found and found[-1][1] == code - 1:
            found[-1][1] = code
        else:
            found.append([code, code])
    return "".join(rf"\u{a:04x}-\u{b:04x}" for a, b in found)


class _Known(dict):
    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = _packed(self.codec.word_ids(word.encode("utf-8", "surrogatepass")))
        if len(word) <= SHORT_WORD:
            if len(self) >= WORDS_KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


_CODECS: dict[str, Codec] = {}


def _codec(raw: bytes) -> Codec:
    """One codec for each vocabulary and Python worker."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(raw)
    return _CODECS[key]


class Tokenizer:
    """Encoding and decoding of columns of a frame.

    Texts: null and empty ones give no ids; strings of special tokens in a text
    become those tokens; texts of any length are encoded whole. Ids: null gives
    an empty text, ids outside the vocabulary are skipped, special tokens are
    written out, bytes that are not UTF-8 become the replacement character.
    Rows are handled one by one, repeated rows alike, and all other columns stay;
    a new column replaces one of its name. A task works on a few megabytes at a time.
    """

    def __init__(self, spark: SparkSession, vocabulary: str):
        raw = Path(vocabulary).read_bytes()
        if len(raw) > MOST_BYTES:
            raise ValueError(f"{vocabulary} has {len(raw)} bytes; at most {MOST_BYTES} are broadcast")
        self._shared = spark.sparkContext.broadcast(raw)

    def encode(self, df: DataFrame, text: str, ids: str, decoded: str | None = None) -> DataFrame:
        """Adds the column ``ids``, and with ``decoded`` the text decoded from them."""
        made = {ids: "array<int>"} | ({decoded: "string"} if decoded else {})

        def work(codec: Codec, texts: pa.Array) -> list[pa.Array]:
            found, ends = bytearray(), [0]
            for one in texts:
                found += codec.encode(one.as_py() or "")
                ends.append(len(found) // _ID_BYTES)
            values = np.frombuffer(found, np.int32)
            out = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))]
            if decoded:
                out.append(pa.array([codec.decode(values[a:b]) for a, b in zip(ends, ends[1:])], pa.string()))
            return out

        return self._added(df, text, made, work)

    def decode(self, df: DataFrame, ids: str, text: str) -> DataFrame:
        """Adds the column ``text``."""

        def work(codec: Codec, lists: pa.Array) -> list[pa.Array]:
            empty = pa.array([], pa.int32())
            values = [(x.values if x.is_valid else empty).fill_null(-1).to_numpy() for x in lists]
            return [pa.array([codec.decode(v) for v in values], pa.string())]

        return self._added(df, ids, {text: "string"}, work)

    def _added(
        self, df: DataFrame, source: str, made: dict[str, str], work: Callable[[Codec, pa.Array], list[pa.Array]]
    ) -> DataFrame:
        shared = self._shared
        others = [f for f in df.schema.fields if f.name not in made]
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), *(f"`{n}` {t}" for n, t in made.items())])
        names = [*(f.name for f in others), *made]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(shared.value)
            for batch in batches:
                rows = max(1, int(batch.num_rows * _PIECE / max(_PIECE, batch.nbytes)))
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    columns = [*part.columns[:-1], *work(codec, part.column(len(others)))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        return df.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{source}`").alias("_source")).mapInArrow(run, schema)
