"""Train / test / validation split and prior sampling by period."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sampling import PRIOR_SEED, SPLIT_SEED, kept
from tidemark.options import TOP_PRIOR, Options, SpineColumns
from tidemark.sources.staging import pinned


@dataclass(frozen=True)
class SplitPlan:
    """``val_from``: first validation period (None: no validation rows).
    ``fractions``: per train period the kept share of each class, or None."""

    spine: SpineColumns
    val_from: date | None
    train_size: float
    fractions: DataFrame | None

    def split(self) -> Column:
        """The split of a row, from its key alone."""
        s = self.spine
        trained = F.when(kept(self.train_size, SPLIT_SEED, s.ident, s.date), "train").otherwise("test")
        if self.val_from is None:
            return trained
        return F.when(F.col(s.date) >= F.lit(self.val_from), "val").otherwise(trained)

    def assign(self, df: DataFrame) -> DataFrame:
        """Adds the split column; keeps every row."""
        return df.withColumn(self.spine.ind_split, self.split())

    def sample(self, df: DataFrame) -> DataFrame:
        """Thins the train rows of an assigned frame to the wanted priors."""
        if self.fractions is None:
            return df
        s = self.spine
        share = F.coalesce(
            F.when(F.col(s.target) == 1, F.col("_keep_pos")).when(F.col(s.target) == 0, F.col("_keep_neg")), F.lit(1.0)
        )
        return (
            df.join(self.fractions.withColumnRenamed("month", s.date), s.date, "left")
            .where((F.col(s.ind_split) != "train") | (share >= 1) | kept(share, PRIOR_SEED, s.ident, s.date))
            .select(*df.columns)
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return self.sample(self.assign(df))


def fit_split(df: DataFrame, options: Options) -> SplitPlan:
    s = options.spine
    plan = SplitPlan(s, _val_from(df, options), options.train_size, None)
    if options.prior_map is None and options.min_prior is None and options.factor_mult == 1:
        return plan
    train = plan.assign(df).where(F.col(s.ind_split) == "train")
    counts = train.groupBy(F.col(s.date).alias("month")).agg(
        F.count_if(F.col(s.target) == 1).alias("_n1"), F.count_if(F.col(s.target) == 0).alias("_n0")
    )
    return SplitPlan(s, plan.val_from, plan.train_size, pinned(_fractions(counts, options)))


def _val_from(df: DataFrame, options: Options) -> date | None:
    """The earliest of the last ``n_months_val`` periods; a literal, so that
    split filters prune partitions of the source."""
    if options.n_months_val <= 0:
        return None
    column = options.spine.date
    last = df.select(column).distinct().orderBy(F.col(column).desc_nulls_last()).limit(options.n_months_val)
    return min((row[0] for row in last.collect() if row[0] is not None), default=None)


def _fractions(counts: DataFrame, options: Options) -> DataFrame:
    n1, n0, q, p = F.col("_n1"), F.col("_n0"), F.col("_q"), F.col("_p")
    base = p
    if options.prior_map:
        pairs = [F.lit(x) for month, prior in options.prior_map.items() for x in (month, float(prior))]
        base = F.coalesce(F.try_element_at(F.create_map(*pairs), F.date_format("month", "yyyy-MM-dd")), p)
    wanted = base * F.lit(float(options.factor_mult))
    if options.min_prior is not None:
        wanted = F.greatest(wanted, F.lit(float(options.min_prior)))
    mixed = (n1 > 0) & (n0 > 0)
    refused = F.raise_error(F.lit(f"factor_mult asks for a prior above {TOP_PRIOR}"))
    return (
        counts.withColumn("_p", F.try_divide(n1, n0 + n1))
        .withColumn("_q", F.when(mixed & (wanted > TOP_PRIOR) & (wanted > p), refused).otherwise(wanted))
        .select(
            "month",
            F.when(mixed & (q < p), n0 * q / ((1 - q) * n1)).otherwise(1.0).alias("_keep_pos"),
            F.when(mixed & (q > p), n1 * (1 - q) / (q * n0)).otherwise(1.0).alias("_keep_neg"),
        )
    )
