"""The corpus pipeline: five stages over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of ``documents``. Other columns of the input
pass through the first four stages whatever they are called, a null text never
fails a stage, and an empty table gives an empty result.

The last document that a source gives to the mix may be taken in part: its
leading words with single blanks between them. Rows that repeat doc_id, source
and text share their part evenly; what the division leaves is dropped, fewer
words than there are such rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, minhash, mixing, quality, substrings
from tidemark.llm.words import word_array, word_count
from tidemark.sources.staging import stage

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names no operator uses, and the new name of each column."""
    plain = docs.toDF(*[f"own{i}" for i in range(len(docs.columns))])
    return plain, dict(zip(docs.columns, plain.columns))


def _named(plain: DataFrame, own: dict[str, str], text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` again; with ``text``, that text and its length."""
    new = {} if text is None else {"text": text, "n_chars": F.length(text).cast("long")}
    return plain.select(*[new.get(name, F.col(c)).alias(name) for name, c in own.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    spec = quality.QualitySpec()
    plain, own = _plain(docs)
    key = own["doc_id"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias(key), "quality")
    trusted = quality.trusted_rows(labels, key, F.col("quality") == 1, spec)
    return _named(quality.judge(plain, key, own["text"], trusted, spec).where("kept"), own)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; rows with one doc_id stay or go together."""
    plain, own = _plain(docs)
    key = own["doc_id"]
    groups = minhash.near_groups(plain.select(key, own["text"]), key, own["text"], minhash.NearSpec())
    gone = groups.where(~F.col("kept")).select(F.col(key).alias("gone")).distinct()
    return _named(plain.join(gone, F.col(key) == F.col("gone"), "left_anti"), own)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur earlier; documents of which nothing is left go."""
    plain, own = _plain(docs)
    done = substrings.remove_repeats(plain, own["doc_id"], own["text"], whole_characters=True)
    left = done.where((F.col("n_removed") == 0) | (F.octet_length("kept") > 0))
    text = F.when(F.col("n_removed") == 0, F.col(own["text"])).otherwise(F.col("kept").cast("string"))
    return _named(left, own, text)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken whole, and one with its
    leading words for a part. Rows that repeat doc_id, source and text share what they get."""
    plain, own = _plain(docs)
    doc, source, text = own["doc_id"], own["source"], F.col(own["text"])
    rows = plain.withColumn("tie", F.md5(F.coalesce(text, F.lit(""))))
    entries = rows.select(F.col(doc).alias("doc"), F.col(source).alias("from"), F.col("tie").alias("same"), word_count(text).alias("words"))
    entries = entries.groupBy("doc", "from", "same").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("copies"))
    got = mixing.mix(entries, "doc", "words", "from", ["same"]).where("taken > 0")
    got = got.select("doc", "from", "same", "words", "copies", "taken")
    on = F.col(doc).eqNullSafe(F.col("doc")) & F.col(source).eqNullSafe(F.col("from")) & (F.col("tie") == F.col("same"))
    times = F.floor(F.col("taken") / F.col("words")).cast("int")
    rest = F.floor(F.pmod("taken", "words") / F.col("copies")).cast("int")
    parts = F.concat(F.array_repeat(F.lit(-1), times), F.filter(F.array(rest), lambda n: n > 0))
    taken = rows.join(got, on).withColumn("part", F.explode(parts))
    leading = F.array_join(F.slice(word_array(text), 1, F.greatest("part", F.lit(0))), " ")
    return _named(taken, own, F.when(F.col("part") < 0, text).otherwise(leading))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether decoding them gives the text again."""
    tokenizer = bpe.Tokenizer(spark, VOCABULARY)
    decoded = tokenizer.encode(docs.select("doc_id", "source", "text"), "text", "token_ids", "_decoded")
    return decoded.select(
        "doc_id",
        "source",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        (F.col("_decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", substring_dedup),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]

# Hashes, refined buckets and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.split()[0].lower())
    return docs
