"""Row sampling by key hash: no shuffle, the same rows on every run and under
every partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import period_text

# One seed per use keeps the draws independent.
SPLIT_SEED = 2012
PRIOR_SEED = 2013
RESAMPLE_SEED = 2014

HASH_RANGE = 4294967296


def key_hash(seed: int, ident: Column | str, period: Column | str) -> Column:
    """First 32 bits of md5(seed|ident|yyyy-MM-dd) as a bigint."""
    ident = F.col(ident) if isinstance(ident, str) else ident
    text = F.concat_ws("|", F.lit(str(seed)), ident.cast("string"), period_text(period))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def kept(fraction: Column | float, seed: int, ident: Column | str, period: Column | str) -> Column:
    """True for about ``fraction`` of the keys."""
    share = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return key_hash(seed, ident, period) < share * F.lit(float(HASH_RANGE))
