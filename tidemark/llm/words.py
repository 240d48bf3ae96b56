"""Words, shingles and min-hash signatures of text columns.

A word is a run of characters outside space and tab to carriage return. The
column form runs in the JVM; the array form works on the UTF-8 bytes of many
texts at once and hashes words to 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_BLOCK_BYTES = 2 << 20
_SEED = 20_240_607


def word_array(text: Column) -> Column:
    """All words in order; none for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=64)
def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit values."""
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE_VALUES = random_words(256, _SEED)


def byte_classes(lower: bool = True, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: its folded value, and whether it separates words.

    ``letters_only`` also lets every ASCII character but letters and digits separate.
    """
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[ord("A") : ord("Z") + 1] += 32
    gap = np.zeros(256, bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    if letters_only:
        gap[:128] = [not chr(b).isalnum() for b in range(128)]
    return fold, gap


def text_blocks(column: pa.Array, most: int = _BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first row, bytes, row starts in them); nulls are empty.

    A block holds about ``most`` bytes, or one longer text.
    """
    column = column.cast(pa.binary()).fill_null(b"")
    starts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[starts[first] : starts[last]], starts[first : last + 1].astype(np.int64) - starts[first]
        first = last


def word_hashes(
    data: np.ndarray, starts: np.ndarray, classes: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and where each text's words start in that array."""
    fold, gap = classes
    inside = ~gap[data]
    opens = inside.copy()
    if len(data):
        inner = starts[(starts > 0) & (starts < len(data))]
        opens[1:] &= ~inside[:-1]
        opens[inner] = inside[inner]
    begins = np.flatnonzero(opens)
    first_word = np.searchsorted(begins, starts)
    if not len(begins):
        return np.zeros(0, np.uint64), first_word
    at = np.flatnonzero(inside)
    first_byte = np.searchsorted(at, begins)
    lengths = np.diff(np.append(first_byte, len(at)))
    offset = np.arange(len(at)) - np.repeat(first_byte, lengths)
    weights = mixed(np.arange(int(lengths.max()), dtype=np.uint64) + np.uint64(_SEED)) | np.uint64(1)
    sums = np.add.reduceat(_BYTE_VALUES[fold[data[at]]] * weights[offset], first_byte)
    return mixed(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first_word


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    factors = random_words(size, _SEED + 1)
    width = min(size, len(words))
    runs = len(words) - width + 1
    total = np.full(runs, width, np.uint64)
    for k in range(width):
        total = mixed(total + words[k : k + runs] * factors[k])
    return total


class MinHash:
    """Min-hash signatures of ``count`` coordinates."""

    def __init__(self, count: int, seed: int = _SEED + 2):
        self.factors = random_words(count, seed)
        self.salts = random_words(count, seed + 1)

    def __call__(self, members: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(members), 4096):
            part = members[at : at + 4096, None]
            least = np.minimum(least, ((part ^ self.salts) * self.factors).min(axis=0))
        return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)
