"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import bpe, chat, forest, licenses, lines, minhash, mixing, negatives, quality, ring, substrings, trie, warc
from tidemark.llm.words import word_count
from tidemark.operators.skew import split_join
from tidemark.sources.staging import fresh_path, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = tokenizer.encode(docs, "text", "ids", "decoded")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


ORACLE_VECTORS = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (
  select vec_id as node, vec_id as root from embeddings
  union
  select l.b, r.root from reach r join links l on l.a = r.node where r.root < l.b),
counted as (select a, count(*) as n from links group by a)
select vec_id, coalesce(any_value(n), 0)::bigint as n_links, min(root) as component_id, min(root) = vec_id as kept
from embeddings join reach on node = vec_id left join counted on a = vec_id group by vec_id
"""


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = quality.QualitySpec()
    labels = table(spark, sf_dir, "labels")
    trusted = quality.trusted_rows(labels, "doc_id", F.col("quality") == 1, spec)
    judged = quality.judge(table(spark, sf_dir, "documents"), "doc_id", "text", trusted, spec)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = minhash.NearSpec(width=3, percent=85)
    return minhash.near_groups(table(spark, sf_dir, "documents"), "doc_id", "text", spec)


ORACLE_NEAR = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents where text is not null),
sets as (
  select distinct doc_id, case when len(w) < 3 then w else w[i:i + 2] end as s
  from words, lateral (select unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id
  group by 1, 2),
links as (
  select s.a, s.b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
  where 100 * s.n >= 85 * (x.n + y.n - s.n)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as node, doc_id as root from documents
  union
  select e.b, r.root from reach r join both_ways e on e.a = r.node where r.root < e.b)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(min(root), d.doc_id) as component_id,
  min(root) >= d.doc_id as kept
from documents d left join sizes using (doc_id) join reach on node = d.doc_id group by d.doc_id, n
"""


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), "page_id", "url", "html", folder)
    return warc.read(manifest, folder).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row becomes a message and its text two delta events; rows of one turn stay apart."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    half = F.floor(F.length("text") / 2).cast("int")
    parts = F.array(F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text")))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    events = rows.union(planted).withColumn("message", F.row_number().over(in_order)).select(
        "conv_id", "message", "role", F.posexplode(parts).alias("sequence", "text"), F.lit("delta").alias("kind")
    )
    rendered = chat.render(events, "conv_id", "message", "sequence", "kind", "role", "text")
    return chat.summaries(rendered).withColumnRenamed("conversation", "conv_id")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, "doc_id", "text").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = ring.place(rows, "doc_id", ["text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("tie")
    )
    return mixing.mix(rows, "doc_id", "size", "source", ["tie"]).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, "doc_id", "text").select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE_LINES = r"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
each as (
  select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as pos,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from split),
common as (
  select key, max(doc_id) as keeper from each where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
judged as (select e.*, c.key is not null and e.doc_id <> c.keeper as gone from each e left join common c using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", noisy.alias("label"))
    return negatives.mine(rows, "vec_id", "embedding", "label", F.col("vec_id") % 50 == 0)


ORACLE_NEGATIVES = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over w::int as rank, vec_id as negative_id, positive_score,
  score as negative_score
from positives join scores using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 3
"""


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = stage(trie.positions(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"), "said")
    turns, convs = _rebuilt(said)
    found = trie.build(turns, convs)
    return found.nodes.join(trie.digests(found), ["n1", "n2"]).drop("n1", "n2")


def _rebuilt(said: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns replaced by those of conversation c - c % 100."""
    own = said.groupBy("conv").agg(F.count(F.lit(1)).alias("n_own")).withColumns(
        {"h": F.crc32(F.col("conv").cast("string").cast("binary")) % 6, "base": F.col("conv") - F.col("conv") % 100}
    )
    heads = said.where((F.col("conv") % 100 == 0) & (F.col("pos") <= 5)).withColumnRenamed("conv", "base")
    convs = own.join(heads.groupBy("base").agg(F.count(F.lit(1)).alias("n_head")), "base", "left")
    taken = F.least("h", F.coalesce("n_head", F.lit(0)))
    convs = stage(
        convs.select("conv", "base", "h", "n_own", taken.alias("taken")).withColumn(
            "length", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))
        ),
        "convs",
    )
    columns = ["conv", "pos", "t1", "t2", "chars"]
    shared = convs.join(heads, "base").where(F.col("pos") <= F.col("h")).select(*columns)
    later = split_join(said, convs.select("conv", "h", "taken", "n_own"), ["conv"], "n_own").where(F.col("pos") > F.col("h"))
    later = later.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")).select(*columns)
    return shared.unionByName(later), convs.select("conv", "length")


ORACLE_PREFIXES = """
with recursive convs as (select distinct conv_id as c from conversations where conv_id is not null),
hashed as (
  select c, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 as h
  from convs),
lists as (
  select conv_id as c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations group by conv_id),
rebuilt as (
  select h.c, list_concat(coalesce(b.turns, [])[1:h.h], o.turns[h.h + 1:]) as turns
  from hashed h join lists o on o.c = h.c left join lists b on b.c = h.c - h.c % 100),
members as (select c, turns, unnest(range(0, len(turns) + 1)) as depth from rebuilt),
nodes as (
  select turns[1:depth] as path, depth, min(c) as conv_id, count(*) as n_convs,
    coalesce(string_agg(c::varchar, ',' order by c) filter (where len(turns) = depth), '') as ends
  from members group by all),
sized as (
  select *, (n_convs - 1) * (case when depth = 0 then 0 else length(path[depth].text) end) as saved,
    path[1:depth - 1] as parent from nodes),
counted as (select parent, count(*) as n_children from sized where depth > 0 group by parent),
inner_nodes as (
  select s.*, coalesce(n_children, 0) as n_children, p.conv_id as parent_conv_id
  from sized s left join counted k on k.parent = s.path left join nodes p on s.depth > 0 and p.path = s.parent
),
spread as (select unnest(range(0, depth + 1)) as up, path, saved, n_children from inner_nodes),
below as (
  select path[1:up] as path, sum(saved)::bigint as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
  from spread group by 1)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) as ends_sha256
from inner_nodes join below using (path)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_bpe": op1_bpe,
    "op2_minhash": op2_minhash,
    "op3_warc": op3_warc,
    "op4_chat": op4_chat,
    "op5_substrings": op5_substrings,
    "op6_sharding": op6_sharding,
    "op7_licenses": op7_licenses,
    "op8_mixing": op8_mixing,
    "op9_vectors": op9_vectors,
    "op10_quality": op10_quality,
    "op11_lines": op11_lines,
    "op12_negatives": op12_negatives,
    "op13_prefixes": op13_prefixes,
}

ORACLE: dict[str, str] = {
    "op2_minhash": ORACLE_NEAR,
    "op8_mixing": mixing.ORACLE,
    "op9_vectors": ORACLE_VECTORS,
    "op11_lines": ORACLE_LINES,
    "op12_negatives": ORACLE_NEGATIVES,
    "op13_prefixes": ORACLE_PREFIXES,
}
