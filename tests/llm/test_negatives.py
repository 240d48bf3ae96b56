"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from tidemark.llm import negatives as n

LONG = 1 << 63


def brute(rows, spec):
    sound = {
        (k, lab, tuple(min(max(math.floor(x * spec.scale), -LONG), LONG - 1) for x in v))
        for k, v, lab in rows
        if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for a in [r for r in sound if r[0] is not None and r[0] % 10 == 0]:
        scored = []
        for b in sound:
            if b[0] != a[0] and len(a[2]) == len(b[2]):
                score = min(max(sum(x * y for x, y in zip(a[2], b[2])), -LONG), LONG - 1)
                scored.append((-score, b[0] is None, b[0] or 0, b))
        scored.sort(key=lambda t: t[:3])
        best = [(-s, b[0]) for s, _, _, b in scored if b[1] == a[1]][: spec.positives]
        for p, positive in best:
            found = [(-s, b[0]) for s, _, _, b in scored if b[1] != a[1] and spec.low * p <= -100 * s <= spec.high * p]
            out += [(a[0], positive, r, k, p, s) for r, (s, k) in enumerate(found[: spec.negatives], 1)]
    return sorted(out, key=str)


def rows(seed=4, scale=1.0):
    r = random.Random(seed)
    base = [[r.gauss(0, scale) for _ in range(20)] for _ in range(6)]
    out = [(i, [x + r.gauss(0, 0.5 * scale) for x in base[i % 6]], r.choice([0, 0, 0, 1, 2])) for i in range(230)]
    out += [(300 + i, base[i % 3], 5) for i in range(40)] + [(20, base[1], 0), (20, base[2], 1), (None, base[0], 0)]
    out += [(400, None, 1), (401, [float("nan")] * 20, 1), (402, [None] * 20, 1), (410, base[0], None), (420, [], 1), (421, [], 1)]
    out += [(430, base[0][:3], 1), (431, base[1][:3], 1), (432, base[0][:3], 2), (440, [0.0] * 20, 1), (423, [], 2), (3, base[0], 0)]
    return out + out[:5]


def mined(spark, data, spec):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("key", "v", "d", "anchor", "at", "no", "rank")})
    found = n.mine(df, "vec_id", "embedding", "label", F.col("vec_id") % 10 == 0, spec)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("spec", [n.NegativeSpec(), n.NegativeSpec(block=16, anchors=5), n.NegativeSpec(3, 7, 20, 99, 1000, 64, 2)])
def test_negatives_equal_brute_force(spark, spec):
    data = rows()
    found = mined(spark, data, spec)
    assert found == brute(data, spec) and len(found) > 300


@pytest.mark.parametrize("scale", [3e7, 1e200])
def test_scores_beyond_doubles_and_longs(spark, scale):
    data = rows(5, scale)[:60]
    assert mined(spark, data, n.NegativeSpec(block=16)) == brute(data, n.NegativeSpec())


def test_empty_and_anchorless(spark):
    assert mined(spark, rows()[:0] + [(1, [1.0], 0), (2, [1.0], 1)], n.NegativeSpec()) == []
    assert mined(spark, [(10, [1.0], 0)], n.NegativeSpec()) == []
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert n.mine(df, "vec_id", "embedding", "label", F.col("vec_id") % 10 == 0).count() == 0


def test_the_bitmap_shrinks():
    """Dimensions read for a row end when its bounds decide."""
    r = np.random.default_rng(1)
    columns = r.integers(-20, 20, (64, 4096))
    anchor = np.concatenate([r.integers(50, 99, 8), r.integers(-3, 3, 56)])
    block = n.Block(np.arange(4096), np.zeros(4096, bool), np.zeros(4096, np.int64), columns)
    seen = []

    def narrow(partial, low, high):
        bar = np.partition(partial, len(partial) - 5)[len(partial) - 5] if len(partial) > 5 else -math.inf
        seen.append(len(partial))
        return partial + high >= bar + low

    rows, scores = n.scan(anchor, block, np.ones(4096, bool), narrow)
    exact = anchor @ columns
    assert {int(i) for i in np.argsort(-exact)[:5]} <= set(rows.tolist()) and (scores == exact[rows]).all()
    assert seen[0] == 4096 and seen[2] < 1000 and seen[-1] <= 10
