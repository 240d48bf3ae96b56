"""License notices in documents, by min-hash bands over overlapping text windows.

Texts and templates are lower-cased in A-Z and cut into words of letters and
digits. For every template length class (lengths within a quarter), windows
overlap by the class width, so each occurrence of a template lies whole in one.
A band is one min-hash coordinate: window and template agree in it with a
probability of their similarity, which ``containment`` and the window width
bound from below; there are as many bands as it takes for all to differ with
probability ``miss`` at most. Windows that share a band with a template are
verified: the share of the template's ``shingle``-word shingles that the window
holds, by exact count, must be at least ``containment``. A template of fewer
words is one shingle of all its words, and texts are cut at that width for it.

Templates are a parameter, at most ``MOST_TEMPLATES``, and travel with the
tasks; documents need no shuffle. A document's windows are hashed in pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import byte_classes, random_words, shingles, text_blocks, word_hashes

MOST_TEMPLATES = 10_000

# Short notices as licenses ask for them in files.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "proprietary": "All rights reserved. Unauthorized copying of this file, via any medium is strictly prohibited.",
    "all-rights-reserved": "All rights reserved.",
}


def usual() -> dict[str, str]:
    """The short notices, and the headers and full texts kept in ``notices/``."""
    files = (f for f in resources.files("tidemark.llm").joinpath("notices").iterdir() if f.name.endswith(".txt"))
    return NOTICES | {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in sorted(files, key=lambda f: f.name)}


@dataclass(frozen=True)
class ScanSpec:
    shingle: int = 5
    containment: float = 0.8
    miss: float = 1e-6
    seed: int = 13


@dataclass(frozen=True)
class _Class:
    """Templates of at most ``width`` words, cut into shingles of ``shingle``, of which
    a window of ``span`` must hold ``need``; ``known`` band keys and whose they are."""

    shingle: int
    width: int
    step: int
    span: int
    need: int
    bands: int
    known: np.ndarray
    leading: np.ndarray
    owners: list[list[int]]


def _words(texts: list[str]) -> list[np.ndarray]:
    classes = byte_classes(letters_only=True)
    out = []
    for _, data, starts in text_blocks(pa.array(texts, pa.string())):
        hashes, first = word_hashes(data, starts, classes)
        out += [hashes[a:b] for a, b in zip(first, first[1:])]
    return out


def _span(shingle: int, width: int, step: int) -> int:
    """Shingles of a window, in whole steps."""
    return -(-max(1, width + step - shingle) // step) * step


def _banded(members: np.ndarray, bands: int, seed: int) -> np.ndarray:
    """Per shingle its place in the order of every band; the least of a window is its coordinate."""
    salts, factors = random_words(bands, seed), random_words(bands, seed + 1)
    return (members[:, None] ^ salts) * factors


def _prepared(templates: list[str], spec: ScanSpec) -> tuple[list[np.ndarray], list[_Class]]:
    words = _words(templates)
    sets = [np.unique(shingles(w, min(spec.shingle, len(w)))) for w in words]
    needs = [math.ceil(spec.containment * len(s) - 1e-9) for s in sets]
    alike: dict[tuple[int, int, int], list[int]] = {}
    for i, w in enumerate(words):
        if len(w):
            width = math.ceil(1.25 ** math.ceil(math.log(len(w), 1.25) - 1e-9))
            step = max(1, width // 4)
            if needs[i] == len(sets[i]):
                # No shingle may be missing: an occurrence is the template, and windows of its length find it.
                width, step = len(w), 1
            alike.setdefault((min(spec.shingle, len(w)), width, step), []).append(i)
    classes = []
    for (shingle, width, step), own in sorted(alike.items()):
        span = _span(shingle, width, step)
        least = min(needs[i] / (max(span, needs[i]) + len(sets[i]) - needs[i]) for i in own)
        bands = max(1, math.ceil(math.log(spec.miss) / math.log(1 - least))) if least < 1 else 1
        found: dict[int, list[int]] = {}
        for i in own:
            for band, key in enumerate(_banded(sets[i], bands, spec.seed).min(axis=0)):
                found.setdefault(int(key) ^ band, []).append(i)
        known = np.array(sorted(found), np.uint64)
        leading = np.zeros(1 << 16, bool)
        leading[known >> np.uint64(48)] = True
        need = min(needs[i] for i in own)
        classes.append(_Class(shingle, width, step, span, need, bands, known, leading, [found[int(k)] for k in known]))
    return sets, classes


def _candidates(members: np.ndarray, kind: _Class, spec: ScanSpec) -> Iterator[tuple[int, int]]:
    """(first shingle, template) of windows that share a band with a template."""
    step, steps = kind.step, kind.span // kind.step
    own = max(1, min(1024, 8192 // step))
    for at in range(0, len(members), own * step):
        piece = members[at : at + (own + steps - 1) * step]
        ordered = _banded(piece, kind.bands, spec.seed)
        least = np.minimum.reduceat(ordered, np.arange(0, len(piece), step), axis=0) if step > 1 else ordered
        keys = least[:own].copy()
        for k in range(1, min(steps, len(least))):
            later = least[k : k + own]
            np.minimum(keys[: len(later)], later, out=keys[: len(later)])
        keys ^= np.arange(kind.bands, dtype=np.uint64)
        # Few keys share their leading bits with a known one; only those are searched.
        windows, bands = np.nonzero(kind.leading[keys >> np.uint64(48)])
        found = keys[windows, bands]
        near = np.minimum(np.searchsorted(kind.known, found), len(kind.known) - 1)
        equal = np.flatnonzero(kind.known[near] == found)
        hits = {(int(windows[k]) * step + at, i) for k in equal for i in kind.owners[near[k]]}
        yield from sorted(hits)


def scan(docs: DataFrame, key: str, text: str, templates: dict[str, str] | None = None, spec: ScanSpec = ScanSpec()) -> DataFrame:
    """(``key``, ``license``, ``containment``, ``first_word``), one row per row of
    ``docs`` and template found in it.

    ``containment`` is the best share among its windows, ``first_word`` the
    number of the first word of the earliest such window's matching shingles.
    Without ``templates``, the ``usual`` ones. Texts are scanned whole; null and
    blank texts hold nothing; a template without words is never found; repeated
    rows give repeated results; a null key stays null.
    """
    named = usual() if templates is None else templates
    if len(named) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    names, bodies = list(named), list(named.values())
    sets, classes = _prepared(bodies, spec)

    def found_in(words: np.ndarray) -> dict[int, tuple[float, int]]:
        cut = {n: shingles(words, n) for n in {kind.shingle for kind in classes} if n <= len(words)}
        best: dict[int, tuple[float, int]] = {}
        for kind in classes:
            members = cut.get(kind.shingle, ())
            if len(members) < kind.need:
                continue
            for at, i in _candidates(members, kind, spec):
                window = members[at : at + kind.span]
                held = np.isin(window, sets[i])
                share = len(np.unique(window[held])) / len(sets[i])
                if share >= spec.containment:
                    where = at + int(np.flatnonzero(held)[0])
                    if i not in best or (share, -where) > (best[i][0], -best[i][1]):
                        best[i] = (share, where)
        return best

    schema = pa.schema([("key", pa.int64()), ("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = byte_classes(letters_only=True)
        for batch in batches:
            rows, ids = [], batch.column(0)
            for first, data, starts in text_blocks(batch.column(1)):
                hashes, at = word_hashes(data, starts, kinds)
                for n, (a, b) in enumerate(zip(at, at[1:])):
                    hits = found_in(hashes[a:b])
                    rows += [(ids[first + n].as_py(), names[i], *hits[i]) for i in sorted(hits)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    out = slim.mapInArrow(run, "key long, license string, containment double, first_word long")
    return out.withColumnRenamed("key", key)
