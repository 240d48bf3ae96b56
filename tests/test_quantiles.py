"""Exact quantiles by counting: odd values, passes that end, and nothing shuffled but counts."""

from __future__ import annotations

import math
import random

import pytest

from pyspark.sql import functions as F
from tidemark.operators import ordering

SPOTS = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.999, "e": 1.0}


def order(x: float) -> tuple:
    return (math.isnan(x), 0.0 if math.isnan(x) else x)


def discrete(values: list[float], p: float) -> float:
    return sorted(values, key=order)[max(math.ceil(p * len(values)), 1) - 1]


def between(values: list[float], p: float) -> float:
    spot, ranked = p * (len(values) - 1), sorted(values, key=order)
    low, high = ranked[math.floor(spot)], ranked[math.ceil(spot)]
    return low if low == high else low + (high - low) * (spot - math.floor(spot))


def odd_columns() -> dict[str, list[float | None]]:
    r = random.Random(1)
    n = 200
    return {
        "wide": [r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300) for _ in range(n)],
        "tail": [r.paretovariate(0.2) for _ in range(n)],
        "tiny": [r.randrange(-40, 40) * 5e-324 for _ in range(n)],
        "near": [1.0 + r.randrange(30) * 2.0**-52 for _ in range(n)],
        "ends": [r.choice([float("inf"), float("-inf"), float("nan"), 1.0, -1.0, 0.0, 1.7e308, -1.7e308]) for _ in range(n)],
        "tied": [7.0 if r.random() < 0.9 else r.random() for _ in range(n)],
        "same": [3.0] * n,
        "some": [None if i % 3 else float(i) for i in range(n)],
    }


@pytest.mark.parametrize(("parts", "interpolate"), [(32, False), (512, True)])
def test_odd_values(spark, parts, interpolate):
    data = odd_columns()
    names = list(data)
    rows = [(None if i % 7 == 0 else i % 2, *values) for i, values in enumerate(zip(*data.values()))]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"{c} double" for c in names)).repartition(3)
    found = ordering.column_quantiles(df, ["g"], names, "column", SPOTS, interpolate, accuracy=parts)
    got = {(r["g"], r["column"]): [r[n] for n in SPOTS] for r in found.collect()}
    pick = between if interpolate else discrete
    for g in (None, 0, 1):
        for c in names:
            values = [r[1 + list(data).index(c)] for r in rows if r[0] == g]
            want = [pick([v for v in values if v is not None], p) for p in SPOTS.values()]
            assert got[g, c] == pytest.approx(want, nan_ok=True, rel=1e-12, abs=0), (g, c)


def test_only_counts_are_shuffled(spark):
    rows = spark.range(200_000).select((F.col("id") % 5).alias("month"), F.sin("id").alias("x"), F.cos("id").alias("y"))
    shared = spark.createDataFrame(
        [(m, c, 0, -1.0, 1.0, -1.0, 1.0) for m in range(5) for c in ("x", "y")],
        "month long, _name string, _id int, _low double, _high double, _from double, _to double",
    )
    counts = ordering._counted(rows, ["month"], ["x", "y"], shared, 16, 0)
    assert sum(r["_in"] for r in counts.collect()) == 400_000
    plan = counts._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # The brackets meet the rows on the month alone, and a partial count stands below the shuffle.
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    assert final.index("partial_count(1)") > final.index("Exchange hashpartitioning")


def test_few_passes_for_many_values(spark, monkeypatch):
    rows = spark.range(300_000).select(F.exp(F.sin("id") * 20).alias("v"))
    passes = []
    real = ordering._narrowed
    monkeypatch.setattr(ordering, "_narrowed", lambda *a: passes.append(1) or real(*a))
    found = ordering.quantiles(rows.select("*", F.lit(1).alias("g")), ["g"], "v", {"m": 0.5}).first()
    want = rows.select(F.expr("percentile_disc(0.5) within group (order by v)")).first()[0]
    assert found["m"] == want and len(passes) <= 5
