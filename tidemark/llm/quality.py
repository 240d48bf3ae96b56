"""Quality rules: fixed base rules and a hashed n-gram likelihood ratio.

Word unigrams and bigrams are hashed to ``buckets``. One multinomial is counted
over the trusted texts, one over the whole corpus; a text's score is the mean
over its n-grams of ln(trusted share / corpus share), and it passes if the score
is at least ``threshold``. Every bucket gets ``smoothing`` trusted n-grams more,
and the corpus as many at its rate, so a bucket that is rare in both is worth
nearly nothing and new words do not count against a text. The
trusted texts come from labelled rows, at most ``max_trusted`` of them (those
with the lowest key hash, so the same on every run); the corpus counts cover
all rows. The weights are ``buckets`` numbers whatever the data, so they reach
the tasks as one array.

Everything is built-in expressions. Each row is judged by itself: repeated rows
get equal verdicts, a null text has no words and fails, other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import word_array

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualitySpec:
    buckets: int = 1 << 16
    smoothing: float = 5.0
    threshold: float = -0.115
    max_trusted: int = 20_000
    min_words: int = 50
    max_repeat_percent: int = 50


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator, so that later expressions over them do
    not compute them once per array element."""
    made = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(made))


def base_metrics(df: DataFrame, text: str, prefix: str = "_q_") -> DataFrame:
    """Adds ``{prefix}hashes`` (of all words), ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines`` and ``n_repeat_words``, all with ``prefix``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    p = prefix
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    held = _held(df, **{f"{p}words": word_array(whole), f"{p}lines": F.transform(lines, lambda x: F.xxhash64(x))})
    words = F.col(f"{p}words")
    n = F.size(words)
    held = _held(held, **{f"{p}hashes": _word_hashes(words)})
    hashes = F.col(f"{p}hashes")

    def window(first: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(first, F.get(hashes, i + 1), F.get(hashes, i + 2)).alias("h"), i.alias("i"))

    placed = F.transform(F.slice(hashes, 1, F.greatest(n - 2, F.lit(0))), window)
    held = _held(held, **{f"{p}windows": placed})
    windows = F.col(f"{p}windows")
    distinct = F.size(F.array_distinct(windows["h"])) == F.size(windows)
    held = _held(held, **{f"{p}sorted": F.when(distinct, F.slice(windows, 1, 0)).otherwise(F.sort_array(windows))})
    ordered = F.col(f"{p}sorted")

    def repeated(x: Column, at: Column) -> Column:
        """The window's start if the one before or after it in hash order is equal."""
        same = (F.get(ordered, at - 1)["h"] == x["h"]) | (F.get(ordered, at + 1)["h"] == x["h"])
        return F.when(same, x["i"])

    starts = F.sort_array(F.filter(F.transform(ordered, repeated), lambda x: x.isNotNull()))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda done, at: F.struct(
            (done["n"] + at + 3 - F.greatest(at, done["end"])).alias("n"), (at + 3).alias("end")
        ),
        lambda done: done["n"],
    )
    return held.select(
        *df.columns,
        hashes,
        n.cast("long").alias(f"{p}n_words"),
        F.aggregate(words, F.lit(0), lambda done, w: done + F.length(w)).cast("long").alias(f"{p}word_chars"),
        F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias(f"{p}n_symbols"),
        (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long").alias(f"{p}n_dup_lines"),
        covered.cast("long").alias(f"{p}n_repeat_words"),
    )


def _grams(words: Column, buckets: int) -> Column:
    """Buckets of all unigrams and bigrams of a held array of ``_word_hashes``."""
    low = F.lit(buckets).cast("long")
    singles = F.transform(words, lambda w: F.pmod(w, low).cast("int"))
    pairs = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), low).cast("int"),
    )
    return F.concat(singles, pairs)


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def trusted_rows(labels: DataFrame, key: str, good: Column, spec: QualitySpec) -> DataFrame:
    """Keys of at most ``max_trusted`` labelled rows that are good."""
    keys = labels.where(good & F.col(key).isNotNull()).select(key).distinct()
    return keys.orderBy(F.xxhash64(key), key).limit(spec.max_trusted)


def weights(docs: DataFrame, key: str, text: str, trusted: DataFrame, spec: QualitySpec) -> DataFrame:
    """One row with ``weights``, an array of ``buckets`` log ratios."""
    flag = trusted.select(F.col(key).alias("_trusted"))
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    # At most max_trusted keys, so the broadcast does not grow with the data.
    rows = rows.join(F.broadcast(flag), F.col("_key") == F.col("_trusted"), "left")
    rows = _held(rows.select("_text", F.col("_trusted").isNotNull().cast("int").alias("_good")), _w=_word_hashes(word_array(F.col("_text"))))
    counted = (
        rows.select("_good", F.explode(_grams(F.col("_w"), spec.buckets)).alias("_bucket"))
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_all"), F.sum("_good").alias("_of_good"))
    )
    every = docs.sparkSession.range(spec.buckets).select(F.col("id").cast("int").alias("_slot"))
    filled = every.join(counted, F.col("_slot") == F.col("_bucket"), "left").select(
        "_slot", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("_all", "_of_good")]
    )
    cells = filled.agg(
        F.array_sort(F.collect_list(F.struct("_slot", "_all", "_of_good"))).alias("_cells"),
        F.sum("_all").alias("_n"),
        F.sum("_of_good").alias("_n_good"),
    )
    # As many trusted n-grams as the bucket would have at the corpus rate.
    rate = F.coalesce(F.col("_n_good") / F.nullif(F.col("_n"), F.lit(0.0)), F.lit(0.0))
    add = F.lit(spec.smoothing)
    ratio = F.transform("_cells", lambda c: F.log(c["_of_good"] + add) - F.log(c["_all"] * rate + add))
    return cells.select(ratio.alias("weights"))


def judge(docs: DataFrame, key: str, text: str, trusted: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """Adds the base metrics, ``base_failed``, ``score`` and ``kept``.

    ``score`` is null without words. ``trusted`` has the keys of ``trusted_rows``.
    """
    table = weights(docs, key, text, trusted, spec).scalar()
    grams = _held(base_metrics(docs, text), _q_grams=_grams(F.col("_q_hashes"), spec.buckets)).drop("_q_hashes")
    total = F.aggregate("_q_grams", F.lit(0.0), lambda done, g: done + F.get(F.col("_q_table"), g))
    scored = grams.withColumn("_q_table", table).select(
        *[c for c in grams.columns if c != "_q_grams"],
        F.when(F.size("_q_grams") > 0, total / F.size("_q_grams")).alias("_q_score"),
    )
    n, repeat = F.col("_q_n_words"), F.col("_q_n_repeat_words")
    failed = (n < spec.min_words) | (100 * repeat > spec.max_repeat_percent * n)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return scored.select(
        *[c for c in docs.columns if c not in (*names, "base_failed", "score", "kept")],
        *[F.col(f"_q_{c}").alias(c) for c in names],
        failed.alias("base_failed"),
        F.col("_q_score").alias("score"),
        (~failed & F.coalesce(F.col("_q_score") >= spec.threshold, F.lit(False))).alias("kept"),
    )
