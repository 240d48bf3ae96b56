"""Operators against brute force on small rows: nulls, empty and long texts,
ties, repeated rows, empty tables, extra columns."""

from __future__ import annotations

import collections
import hashlib
import heapq
import math
import random
import re

import check_oracle
import duckdb
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer as Library

from pyspark.sql import functions as F
from tidemark.llm import bpe, chat, components, forest, licenses, minhash, mixing, quality, queries, ring, substrings, warc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, source string, kept string, component_id string, rep string"


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def frame(spark, texts, sources=None):
    """Texts as documents, with columns whose names the operators use themselves."""
    rows = [(i, t, (sources or {}).get(i, "s"), "k", "c", "r") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_bpe_equals_the_library(spark):
    r = random.Random(4)
    bits = ["a", "the", "  ", "\n", "19", "'s", "é", "日本", "🎉", "<|endoftext|>", "<|endo", "\x1c", "\x85", "\x00", "՘", "ing"]
    texts = [None, "", " ", "x" * 3000, *("".join(r.choices(bits, k=r.randint(0, 50))) for _ in range(60))]
    docs = frame(spark, [*enumerate(texts), (0, None)])
    tokenizer = bpe.Tokenizer(spark, VOCABULARY)
    rows = tokenizer.encode(docs, "text", "ids", "decoded").collect()
    library = Library.from_file(VOCABULARY)
    assert len(rows) == len(texts) + 1
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert row["rep"] == "r"
    odd = spark.createDataFrame([(None,), ([-1, 99_999_999, 39],), ([],), ([None, 39],)], "ids array<int>")
    assert [x["text"] for x in tokenizer.decode(odd.coalesce(1), "ids", "text").collect()] == ["", "H", "", "H"]
    assert tokenizer.encode(docs.limit(0), "text", "ids").count() == 0


def test_long_words_merge_alike():
    with open(VOCABULARY, "rb") as f:
        codec = bpe.Codec(f.read())
    r = random.Random(2)
    for n in range(1, 100):
        word = bytes(r.choices(b"abcthein ", k=n))
        assert codec._merged(word) == codec._merged_long(word)


def test_words_of_the_basic_plane_split_alike():
    with open(VOCABULARY, "rb") as f:
        codec = bpe.Codec(f.read())
    r = random.Random(7)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "'s", "'ll", "'S", "'", "a", "é", "ß", "ª", "²", "Ⅷ", "٣", "日本", "́", "‍", "-", "_", "…"]
    for _ in range(3000):
        text = "".join(r.choices(bits, k=r.randint(0, 12)))
        assert codec.words(text) == codec._basic.findall(text) == codec._words.findall(text)
    # Whole plane: every character alone, after a space and between letters.
    plane = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for text in ("".join(plane), "".join(f" {c}" for c in plane), "".join(f"a{c}" for c in plane)):
        assert codec._basic.findall(text) == codec._words.findall(text)
    assert codec._beyond.search("a\U0001f389") and codec._beyond.search("\u0558") and not codec._beyond.search("".join(bits))


def test_words_kept_in_two_tables(monkeypatch):
    """A word that comes again is merged once, however many rare words come between."""
    with open(VOCABULARY, "rb") as f:
        codec = bpe.Codec(f.read())
    monkeypatch.setattr(bpe, "WORDS_KEPT", 10)
    merged = []
    plain = codec.word_ids
    monkeypatch.setattr(codec, "word_ids", lambda word: merged.append(word) or plain(word))
    library = Library.from_file(VOCABULARY)
    for i in range(200):
        text = f"often rare{chr(97 + i % 26)}{chr(97 + i // 26)}x"
        found = list(memoryview(codec.encode(text)).cast("i"))
        assert found == library.encode(text, add_special_tokens=False).ids
        assert len(codec._known) <= 10 and len(codec._known.older) <= 10
    assert merged.count(b"often") == 1


def expected_groups(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_groups(spark, width, percent):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Éa b c"), (8, "éa b c")]
    for g in range(4):
        base = prose(g, 150).split()
        for k in range(40 if g == 0 else 6):
            r = random.Random(100 * g + k)
            own = list(base)
            for _ in range(k % 7):
                own[r.randrange(len(own))] = "edit"
            texts.append((100 + 50 * g + k, " ".join(own)))
    texts += [(900 + k, prose(77, 60) + " " + prose(500 + k, 90)) for k in range(30)]
    spec = minhash.NearSpec(width=width, percent=percent, block=16)
    found = minhash.near_groups(frame(spark, texts), "doc_id", "text", spec).collect()
    assert {r[0]: (r[1], r[2], r[3]) for r in found} == expected_groups(texts, width, percent)
    assert len(found) == len(texts)


def test_near_groups_of_odd_keys(spark):
    a, b = prose(1, 80), prose(2, 80)
    docs = frame(spark, [(None, a), (None, a), (3, a), (3, b), (3, b), (5, b), (2, a)])
    rows = sorted(minhash.near_groups(docs, "doc_id", "text").collect(), key=str)
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in rows if r[0] is None] == [(None, None, True)] * 2
    assert {(r[0], r[2], r[3]) for r in rows if r[0] is not None} == {(3, 2, False), (5, 2, False), (2, 2, True)}
    assert minhash.near_groups(docs.limit(0), "doc_id", "text").count() == 0


def test_near_groups_of_a_key_with_two_texts(spark):
    a, b = prose(1, 200), prose(2, 200)
    docs = frame(spark, [(3, a), (3, b), (5, b + " other"), (7, a + " other"), (9, prose(3, 80))])
    rows = minhash.near_groups(docs, "doc_id", "text").collect()
    assert sorted((r[0], r[2], r[3]) for r in rows) == [(3, 3, True), (3, 3, True), (5, 3, False), (7, 3, False), (9, 9, True)]


def expected_repeats(texts, length=100):
    seen, out = {}, {}
    for i, t in sorted(texts):
        data = (t or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = [True] * length
            seen.setdefault(w, i)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


@pytest.mark.parametrize("together", [4096, 5])
def test_repeated_strings(spark, together):
    shared, r = prose(1, 60), random.Random(8)
    texts = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 700), (6, "ab" * 300), (7, "é" * 400)]
    for k in range(10, 40):
        cut = r.randrange(len(shared))
        texts.append((k, prose(k, 30) + shared[:cut] + prose(k + 900, 20) + shared[cut // 2 :]))
    texts += [(50, prose(10, 300)), (51, prose(10, 300)), (52, prose(10, 300)[7:])]
    spec = substrings.RepeatSpec(together=together)
    rows = substrings.remove_repeats(frame(spark, texts), "doc_id", "text", spec).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows} == expected_repeats(texts)
    assert {r["rep"] for r in rows} == {"r"}


def test_repeated_strings_of_odd_keys(spark):
    a = prose(1, 80)
    rows = substrings.remove_repeats(frame(spark, [(1, a), (1, a), (None, a), (2, a)]), "doc_id", "text").collect()
    assert sorted((r["doc_id"] or 9, r["n_removed"]) for r in rows) == [(1, 0), (1, 0), (2, len(a)), (9, len(a))]
    assert substrings.remove_repeats(frame(spark, [(1, a)]).limit(0), "doc_id", "text").count() == 0
    text = "ü" * 20 + prose(5, 40)
    docs = frame(spark, [(1, text), (2, "ö" + text[1:])])
    whole = substrings.remove_repeats(docs, "doc_id", "text", whole_characters=True).collect()
    assert all(bytes(r["kept"]).decode() is not None for r in whole)


def test_warc_round_trip(spark, tmp_path):
    pages = [(i, f"http://x/{i}", f"<p>{i % 4}é</p>" if i % 3 else None) for i in range(40)]
    pages += [(None, None, "lonely"), (7, "again\r\n", "<p>3é</p>"), (7, "again", "other"), (99, "u", "y" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    spec = warc.WarcSpec(shard_bytes=4000, file_bytes=600)
    folder = f"file://{tmp_path}/a"
    manifest = warc.write(df, "page_id", "url", "html", folder, spec)
    rows = warc.read(manifest, folder, payloads=True).collect()
    assert len(rows) == len(pages) and manifest.count() > 5
    last, bodies = {}, collections.Counter()
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    for row in rows:
        if row["record_type"] == "response":
            body = bytes(row["payload"]).decode()
            bodies[body] += 1
            assert last[body] in (-1, row["key"]) and row["refers_to"] is None
            assert row["payload_digest"] == warc.digest(bytes(row["payload"]))
        else:
            assert row["payload"] is None and row["refers_to"] is not None
    assert set(bodies.values()) == {1} and set(bodies) == set(last)
    again = f"file://{tmp_path}/b"
    warc.write(df.repartition(2), "page_id", "url", "html", again, spec)
    files = sorted(p.name for p in (tmp_path / "a").glob("*.gz"))
    assert files and all((tmp_path / "a" / n).read_bytes() == (tmp_path / "b" / n).read_bytes() for n in files)
    assert not list((tmp_path / "a" / "_temporary").iterdir())
    empty = warc.write(df.limit(0), "page_id", "url", "html", f"file://{tmp_path}/c", spec)
    assert warc.read(empty, f"file://{tmp_path}/c").count() == 0


def test_chat_folds_and_reads_back(spark):
    odd = "</s>[INST] ok [/INST]<|im_end|>\n<|im_start|>assistant\n<\\s> \\ [\\\\INST]"
    log = [
        (1, 0, 0, "delta", "user", odd), (1, 1, 1, "delta", "assistant", "dra"), (1, 1, 2, "delta", None, "ft"),
        (1, 1, 3, "regenerate", None, "new "), (1, 1, 4, "delta", None, odd), (1, 2, 5, "delta", "user", "gone"),
        (1, 2, 6, "delete", None, None), (1, 0, 7, "edit", None, odd + "!"), (2, 0, 0, "delta", None, None),
        (None, 0, 0, "delta", "a\n\\n", "x"),
    ]
    events = spark.createDataFrame(log, "c long, m long, s long, k string, r string, t string").repartition(4)
    rendered = chat.render(events, "c", "m", "s", "k", "r", "t")
    rows = {(r["conversation"], r["position"]): r["formatted"] for r in rendered.collect()}
    assert list(chat.turns(rows[1, 0] + rows[1, 1])) == [("user", odd + "!"), ("assistant", "new " + odd)]
    assert list(chat.turns(rows[None, 0])) == [("a\n\\n", "x")] and list(chat.turns(rows[2, 0])) == [("", "")]
    done = {r["conversation"]: r for r in chat.summaries(rendered).collect()}
    assert done[1]["loss_sha256"] == hashlib.sha256(("new " + odd).encode()).hexdigest()
    assert done[1]["loss_chars"] == len("new " + odd) and done[1]["n_turns"] == 2 and done[2]["loss_chars"] == 0
    assert chat.summaries(chat.render(events.limit(0), "c", "m", "s", "k", "r", "t")).count() == 0


def test_ring_keeps_counts_level(spark):
    rows = [(i if i % 7 else None, f"t{i % 5}") for i in range(333)] + [(5, "t0")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = ring.place(df, "doc_id", ["text"]).collect()
    by = collections.defaultdict(list)
    for r in found:
        by[r["shard"]].append(r["slot"])
    assert sorted(map(len, by.values())) == [42] * 8 and all(sorted(v) == list(range(42)) for v in by.values())
    assert ring.place(df.limit(0), "doc_id", ["text"]).count() == 0
    # Key by key: every key walks clockwise to the first point with room, in the same rounds.
    spec = ring.RingSpec(4, 8)
    owners = [s for _, s in ring.points(spec)]
    counts = [random.Random(1).randrange(30) for _ in owners]
    pieces = ring.fill(counts, owners, 4)
    total = sum(counts)
    room = [total // 4 + (s < total % 4) for s in range(4)]
    left = {(a, k) for a, n in enumerate(counts) for k in range(n)}
    told = {(a, k): s for a, low, high, s, _ in pieces for k in range(low, high)}
    for step in range(len(owners)):
        for a, k in sorted(left):
            s = owners[(a + step) % len(owners)]
            if room[s]:
                room[s] -= 1
                left.discard((a, k))
                assert told[a, k] == s
    assert not left and sum(p[2] - p[1] for p in pieces) == total


def test_ring_places_every_row_as_a_walk_along_the_ring(spark):
    """``place`` against rows that walk one by one, with columns of the operator's own names."""
    r = random.Random(3)
    keys = [r.choice([None, 7, 7, 7, *range(400)]) for _ in range(500)]
    clash = ["_arc", "_place", "_cell", "_from", "_to", "_rank", "_slot", "shard", "Slot", "count", "c0", "a.b"]
    rows = [(k, i, *clash) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, ["key", "row", *clash]).repartition(4)
    spec = ring.RingSpec(5, 16)
    found = ring.place(df, "key", ["row"], spec)
    assert found.columns == ["key", "row", *[c for c in clash if c.lower() not in ("shard", "slot")], "shard", "slot"]
    nodes = ring.points(spec)
    at = {}
    for i, k in enumerate(keys):
        place = int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:8], 16)
        arc = next((a for a, (p, _) in enumerate(nodes) if place <= p), 0)
        at[i] = (arc, place, k is not None, k or 0, i)
    room = [100] * 5
    expected, slots = {}, collections.Counter()
    waiting = sorted(at, key=at.get)
    for step in range(len(nodes)):
        late = []
        for i in waiting:
            shard = nodes[(at[i][0] + step) % len(nodes)][1]
            if room[shard]:
                room[shard] -= 1
                expected[i] = (shard, slots[shard])
                slots[shard] += 1
            else:
                late.append(i)
        waiting = late
    got = {x["row"]: (x["shard"], x["slot"]) for x in found.collect()}
    assert got == expected and not waiting
    # One more shard: about its own share of the rows moves, and not much more.
    more = {x["row"]: x["shard"] for x in ring.place(df, "key", ["row"], ring.RingSpec(6, 16)).collect()}
    assert sum(more[i] != got[i][0] for i in more) < 0.5 * len(keys)


def test_mixing(spark):
    sources = {i: [None, "a", "b", "é", "z"][i % 5] for i in range(200)}
    texts = [(i, None if i % 50 == 0 else prose(i, 1 + 13 * i % 90)) for i in range(200)] + [(3, prose(3, 40)), (3, prose(3, 40))]
    sized = frame(spark, texts, sources).withColumn("size", F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long"))
    rows = mixing.mix(sized, "doc_id", "size", "source", ["text"]).collect()
    assert len(rows) == len(texts) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    got = collections.Counter()
    for r in rows:
        got[r["source"]] += r["taken"]
    for r in rows:
        assert abs(got[r["source"]] - r["target"]) <= 2
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert mixing.mix(sized.limit(0), "doc_id", "size", "source", ["text"]).count() == 0
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.mix(sized.withColumn("size", F.lit(0)), "doc_id", "size", "source", []).collect())


def quotients(wanted, blocks, shards):
    """Blocks given one by one to the highest quotient: the receiver's count after each shard."""
    heap = [(-w, i, 0) for i, w in enumerate(wanted) if w > 0]
    heapq.heapify(heap)
    have, ends = [0] * len(wanted), []
    for at in range(1, blocks + 1):
        _, i, n = heap[0]
        heapq.heapreplace(heap, (-wanted[i] / (2 * n + 3), i, n + 1))
        have[i] += 1
        ends += [list(have)] * sum(at == blocks * k // shards for k in range(1, shards + 1))
    return [[0] * len(wanted)] * (shards - len(ends)) + ends


MANY = [50] * 30 + [4000]


@pytest.mark.parametrize(("sizes", "block"), [([3, 1, 1, 40, 900, 40, 40, 0, 7], 1), (MANY, 7), (MANY, 500), ([1] * 60, 1), ([5], 1)])
def test_quotas_are_those_of_the_quotients(spark, sizes, block):
    spec = mixing.MixSpec(block=block, shards=3)
    table = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, n long")
    found = mixing.targets(table, spec)
    goals = {r["place"]: r for r in found.collect()}
    assert [goals[i + 1]["n"] for i in range(len(sizes))] == sizes
    wanted = [goals[i + 1]["target"] for i in range(len(sizes))]
    assert sum(wanted) == pytest.approx(1.5 * sum(sizes)) and all(w <= 2 * n for w, n in zip(wanted, sizes))
    level = max(w / (3, 1, 2)[i % 3] for i, w in enumerate(wanted))
    assert all(w == pytest.approx(min(2 * n, level * (3, 1, 2)[i % 3])) for i, (w, n) in enumerate(zip(wanted, sizes)))
    ends = {r["place"]: r["ends"] for r in mixing.apportion(found, spec).collect()}
    expected = quotients(wanted, int(1.5 * sum(sizes) / block + 0.5), 3)
    assert [[ends.get(i + 1, [0] * 3)[s] for i in range(len(sizes))] for s in range(3)] == [[n * block for n in e] for e in expected]


def test_mixing_takes_small_sources_of_large_tables_by_the_same_law(spark):
    sizes = {"hot": 3_000_000, "large": 300_000, "small": 10, "tiny": 1}
    rows = [(i, s, n) for s, n in sizes.items() for i in range(30)] + [(31, None, 7), (32, "none", 0)]
    names = ["target", "source", "size"]
    clash = ["source_size", "taken", "Shard", "parts", "order", "until", "ends", "name", "n", "rows", "c0", "a.b"]
    sized = spark.createDataFrame([(*r, *clash) for r in rows], ["id", *names[1:], *clash]).repartition(3)
    found = mixing.mix(sized, "id", "size", "source", ["name"])
    assert found.columns == ["id", "source", "size", *clash[4:], *mixing.RESULT]
    got, target, held = collections.Counter(), {}, collections.Counter()
    for r in found.collect():
        got[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert (r["shard"] is None) == (r["taken"] == 0) and r["taken"] == sum(p["words"] for p in r["parts"])
        assert r["a.b"] == "a.b" and r["taken"] <= 2 * r["size"]
        for p in r["parts"]:
            held[r["source"], p["shard"]] += p["words"]
    assert all(abs(got[s] - t) <= 1 for s, t in target.items())
    # Shards get equal parts of the mix, and of each source what the quotients give.
    filled = [sum(n for (_, s), n in held.items() if s == k) for k in range(8)]
    assert max(filled) - min(filled) <= 8
    assert max(held["hot", s] for s in range(8)) - min(held["hot", s] for s in range(8)) <= 8
    with pytest.raises(ValueError):
        mixing.MixSpec(weights=(1, 0))


def test_mixing_sql_of_many_sizes(spark, tmp_path):
    """The query and its SQL on sources from one word to half of all."""
    r = random.Random(8)
    sources = ["hot"] * 200 + [f"s{i % 23:02}" for i in range(60)] + ["one", None]
    texts = [None if i % 40 == 3 else prose(i, 1 if s == "one" else r.randrange(1, 300 if s == "hot" else 20)) for i, s in enumerate(sources)]
    rows = list(zip(range(len(texts)), texts, sources))
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    expected = duck.sql(mixing.ORACLE).to_arrow_table()
    assert check_oracle.compare(queries.op8_mixing(spark, str(tmp_path)).toArrow(), expected) == ""


def test_vectors(spark):
    r = random.Random(6)
    base = [[r.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [x + r.gauss(0, 0.05 * (i % 9)) for x in base[i % 12]], i % 2) for i in range(400)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, base[0], None)]
    rows += [(905, base[0][:8], 0), (906, base[0], 0), (907, base[0], 0), (908, [float("inf")] * 16, 1), (909, [1e-300] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    spec = forest.ForestSpec(leaf=32, block=24)
    found = {x[0]: x for x in forest.near_vectors(df, "vec_id", "embedding", "label", spec).collect()}
    good = {i: (v, lab) for i, v, lab in rows if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b)) if len(a) == len(b) else 0

    links = collections.Counter()
    scaled = {i: ([x / max(map(abs, v)) for x in v], lab) for i, (v, lab) in good.items()}
    for a in scaled:
        for b in scaled:
            if a != b and scaled[a][1] == scaled[b][1] and cosine(scaled[a][0], scaled[b][0]) >= 0.93:
                links[a] += 1
    total = sum(links.values())
    assert all(found[i]["n_links"] <= links[i] for i in found) and sum(x["n_links"] for x in found.values()) >= 0.99 * total > 0
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (900, 901, 902, 903, 904, 905, 908))
    assert forest.near_vectors(df.limit(0), "vec_id", "embedding", "label").count() == 0


def test_quality_rules(spark):
    junk = " ".join(f"{w.upper()}### {w}!!" for w in prose(3, 80).split())
    texts = [(1, None), (2, ""), (3, prose(1, 49)), (4, "a b c " * 60), (5, junk)] + [(i, prose(i, 120)) for i in range(10, 60)]
    texts += [(70, prose(70, 60) + "\nline one\n \nline one\nline one")]
    docs = frame(spark, texts)
    trusted = spark.createDataFrame([(i,) for i in range(10, 40)], "doc_id long")
    rows = {r["doc_id"]: r for r in quality.judge(docs, "doc_id", "text", trusted).collect()}
    grams = {i: _grams(t) for i, t in texts}
    every, good = collections.Counter(), collections.Counter()
    for i, g in grams.items():
        every.update(g)
        good.update(g if 10 <= i < 40 else [])
    rate = sum(good.values()) / sum(every.values())
    for i, g in grams.items():
        score = [math.log((good[b] + 5) / (every[b] * rate + 5)) for b in g]
        assert rows[i]["score"] is None if not g else rows[i]["score"] == pytest.approx(sum(score) / len(g), abs=1e-9)
    assert not rows[5]["kept"] and not rows[3]["kept"] and rows[3]["base_failed"] and not rows[1]["kept"]
    assert all(rows[i]["kept"] for i in range(10, 60)) and rows[4]["n_repeat_words"] == 180
    assert (rows[70]["n_dup_lines"], rows[5]["n_symbols"], rows[70]["rep"]) == (2, 240, "r")
    assert quality.judge(docs.limit(0), "doc_id", "text", trusted).count() == 0


def _grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    pairs = [_long_hash(b, _long_hash(a, 42)) for a, b in zip(h, h[1:])]
    signed = [x - (1 << 64) if x >> 63 else x for x in [*h, *pairs]]
    return [x % (1 << 16) for x in signed]


def _long_hash(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)


def test_licenses(spark):
    notice = list(licenses.NOTICES.values())
    texts = [(1, None), (2, ""), (3, notice[1]), (4, prose(1, 500) + " " + notice[0] + " " + prose(2, 300)), (5, prose(3, 50))]
    near = " " + notice[4].replace("License", "Licence")
    texts += [(6, "X " * 30 + notice[2].upper() + "\n" + notice[2]), (7, prose(9, 20) + near), (8, "Licensed under")]
    rows = licenses.scan(frame(spark, texts), "doc_id", "text").collect()
    assert {(r[0], r[1]) for r in rows} == {(3, "MIT"), (4, "Apache-2.0"), (6, "GPL-3.0"), (7, "CC-BY-4.0")}
    assert {r[0]: r[3] for r in rows}[4] == 500 and {r[0]: r[2] for r in rows}[7] < 1
    assert licenses.scan(frame(spark, texts).limit(0), "doc_id", "text").count() == 0


def test_licenses_of_few_words_and_full_texts(spark):
    r = random.Random(8)
    templates = {f"t{i}": prose(900 + i, 1 + i % 8, 30) for i in range(32)}
    texts = []
    for i in range(60):
        body = prose(i, r.choice([0, 1, 2, 7, 60, 3000])).split()
        for t in [templates[f"t{(3 * i + k) % 32}"] for k in range(2)]:
            at = r.randrange(len(body) + 1)
            body[at:at] = t.split()
        texts.append((i, " ".join(body)))
    rows = licenses.scan(frame(spark, texts), "doc_id", "text", templates).collect()
    brute = {(i, n) for i, text in texts for n, t in templates.items() if f" {t} " in f" {text} "}
    assert {(r[0], r[1]) for r in rows} == brute and all(r[2] == 1 for r in rows)
    assert len({n for _, n in brute}) == 32

    known = licenses.usual()
    texts = [(1, prose(1, 900) + "\nAll rights reserved.\n" + prose(2, 900)), (2, "rights reserved. all"), (3, "All rights Reserved")]
    texts += [(i, prose(i, 300) + "\n" + known[n] + "\n" + prose(i, 9)) for i, n in enumerate(known, 10)]
    texts += [(99, known["MIT text"].replace("The above", "This"))]
    rows = licenses.scan(frame(spark, texts), "doc_id", "text").collect()
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows}
    assert got[1, "all-rights-reserved"] == (1, 900) and (2, "all-rights-reserved") not in got
    assert (3, "all-rights-reserved") in got and 0.9 < got[99, "MIT text"][0] < 1
    assert all(got[i, n] == (1, 300) for i, n in enumerate(known, 10))


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (5, 5), (None, 3)] + [(1000, 1000 + i) for i in range(50)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    least = {r["node"]: r["component"] for r in found}
    assert all(least[i] == 0 for i in range(1, 61)) and least[200] == 100 and all(least[1000 + i] == 1000 for i in range(1, 50))
