"""The prefix trie against brute force, over shards and bands of any size."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from pyspark.sql import functions as F
from tidemark.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string, pos int, t1 string, n1 int"


def log(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    rows = []
    for c in [*range(n), *range(200, 200 + n), -5, -100, 10**15]:
        own = r.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, t, r.choice(["user", "assistant"]) if t else "user", r.choice(["", "é", "ab", "x" * 7])) for t in range(own)]
    rows += [(300, t, "user", f"turn {t % 3}") for t in range(200)] + [(301, t, "user", f"turn {t % 3}") for t in range(150)]
    rows += [(302, None, None, None), (302, 0, "user", None), (302, None, None, None), (303, 5, "user", ""), (None, 0, "user", "x")]
    rows += [(1001 + k, 0, "user", "no base") for k in range(12)]
    rows += [(304 + k, t, "user", f"turn {t % 3}") for k in range(30) for t in range(4)]
    return rows


def brute(paths: dict[int, list]) -> list[tuple]:
    held = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            held[tuple(path[:d])].append(c)
    children = collections.Counter(p[:-1] for p in held if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, members in held.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, members in held.items():
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(path))
        parent = min(held[path[:-1]]) if path else None
        told = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], told))
    return sorted(out, key=str)


def spoken(rows: list[tuple]) -> dict[int, list]:
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in by.items()}


@pytest.mark.parametrize("spec", [trie.TrieSpec(), trie.TrieSpec(8, 3), trie.TrieSpec(1, 1)])
def test_trie_equals_brute_force(spark, spec):
    rows = log(2, 40)
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA).repartition(4)
    turns = trie.positions(df, "conv_id", "turn", "role", "text")
    silent = spark.createDataFrame([(777, 0), (-900, 0)], "conv long, length long")
    convs = turns.groupBy("conv").agg(F.count("*").alias("length")).union(silent)
    found = trie.build(turns, convs, spec)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = found.nodes.join(trie.digests(found), ["n1", "n2"]).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == brute(spoken(rows) | {777: [], -900: []})


def test_query_rebuilds_conversations(spark, tmp_path):
    rows = log(3, 25)
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    own = spoken(rows)
    paths = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        paths[c] = own.get(base, [])[:h] + said[h:]
    assert any(not p for p in paths.values())
    got = queries.op13_prefixes(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(paths)


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([(None, 0, "user", "x")], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    assert queries.op13_prefixes(spark, str(tmp_path)).count() == 0


def test_long_end_lists_stream_in_pieces(spark):
    ids = [7 * i for i in range(3000)]
    convs = spark.createDataFrame([(i, 0) for i in ids], "conv long, length long")
    turns = spark.createDataFrame([], "conv long, pos long, t1 long, t2 long, chars long")
    found = trie.build(turns, convs, trie.TrieSpec(shard=700))
    told = trie.digests(found).collect()
    assert [x["ends_sha256"] for x in told] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]
