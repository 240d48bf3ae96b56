"""Line dedup against brute force, and runs that go on after a lost job."""

from __future__ import annotations

import collections
import random
import re

import pytest

from pyspark.sql import functions as F
from tidemark.llm import lines


def expected(rows, min_chars=40, min_docs=5):
    """By (key, text): n_lines, n_dropped, kept."""

    def form(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(lines.BLANKS))

    held = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(form(line)) >= min_chars:
                held[form(line)].add(i)
    last = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(v) >= min_docs}
    out = {}
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if form(x) not in last or last[form(x)] == i]
        out[i, text] = (len(every), len(every) - len(kept), "\n".join(kept))
    return out


def texts() -> list[tuple]:
    r = random.Random(3)
    common = ["É" * 39 + x for x in "abcdefgh"] + ["x" * 39, "y" * 40, " " * 50, "Z " * 20]
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "\n".join(common * 400)), (5, "y" * 100_000 + "\n" + "y" * 40)]
    for i in range(10, 90):
        some = [r.choice(["", " ", "\t\r"]) + r.choice([c, c.lower(), c.upper()]) + r.choice(["", " \x0b\x0c"]) for c in r.choices(common, k=r.randrange(9))]
        own = [f"only {i} {k} " + "w" * r.randrange(60) for k in range(3)]
        rows.append((i, "\n".join(r.sample(some + own, len(some) + 3))))
    return rows + [(20, rows[-1][1]), (20, rows[-1][1]), (None, rows[30][1]), (None, rows[31][1])]


@pytest.mark.parametrize(("batches", "fan_out"), [(1, 2), (4, 2), (7, 3)])
def test_lines_equal_brute_force(spark, batches, fan_out):
    rows = texts()
    schema = "doc_id long, text string, n_lines int, kept string, row string, h1 int, doc int, gone int"
    df = spark.createDataFrame([(i, t, 7, "k", "r", 1, 2, 3) for i, t in rows], schema).repartition(5)
    found = lines.drop_repeated_lines(df, "doc_id", "text", lines.LineSpec(batches=batches, fan_out=fan_out)).collect()
    want = expected(rows)
    assert len(found) == len(rows) and all(tuple(x["row"]) == (7, "k", "r", 1, 2, 3) for x in found)
    got = collections.Counter((x["doc_id"], *x[1:4]) for x in found)
    assert got == collections.Counter((i, *want[i, t]) for i, t in rows)


def test_lines_of_few_columns_and_rows(spark):
    df = spark.createDataFrame([(1.5, "a"), (None, None)], "k double, t string")
    found = lines.drop_repeated_lines(df, "k", "t").collect()
    assert sorted(tuple(x)[1:] for x in found) == [(1, 0, "", None), (1, 0, "a", None)]
    assert lines.drop_repeated_lines(df.limit(0), "k", "t").count() == 0
    same = spark.createDataFrame([(i, "s" * 50) for i in range(300)], "k int, t string")
    found = lines.drop_repeated_lines(same, "k", "t").where(F.col("n_dropped") == 0).collect()
    assert [x["k"] for x in found] == [299]


def test_runs_go_on_after_a_lost_job(spark, tmp_path):
    def batch(*rows):
        return spark.createDataFrame(rows, "h1 long, h2 long, docs long, lines long, keeper long")

    runs = lines.LineRuns(spark, f"file://{tmp_path}/r", buckets=3)
    runs.add(batch((1, 1, 2, 3, 90), (2, 2, 1, 1, 80)), "a")
    before = len(list((tmp_path / "r").glob("tidemark_run_*")))
    runs._write(batch((1, 1, 9, 9, 9)))  # a job that died before its manifest
    for name in runs.runs():
        spark.sql(f"DROP TABLE {name}")  # a new session knows no tables
    again = lines.LineRuns(spark, f"file://{tmp_path}/r", buckets=3)
    again.add(batch((1, 1, 50, 50, 70)), "a")  # known, so nothing happens
    again.add(batch((1, 1, 1, 4, 70), (3, 3, 1, 1, 60)), "b")
    again.add(batch(), "c")
    again.add(batch((3, 3, 2, 2, 50), (2, 2, 1, 1, 40)), "d")
    found = sorted(map(tuple, again.merged().collect()))
    assert found == [(1, 1, 3, 7, 90), (2, 2, 2, 2, 80), (3, 3, 3, 3, 60)]
    assert before == 1 and again.levels == {2: again.runs()} and again.done == ["a", "b", "c", "d"]
    plan = again._open(again.runs()[0])._jdf.queryExecution().toString()
    assert "bucket" in plan.lower()
    again.remove()
