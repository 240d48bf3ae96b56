"""Scores, buckets from ranks, and strength bands."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

LOGIT_CLIP = 1e-6

# Band labels and our thresholds (upper bounds, last one open).
CRAMER_BANDS = ((0.1, "very_weak"), (0.3, "weak"), (0.5, "medium"), (None, "strong"))
MUTUAL_BANDS = ((0.02, "weak"), (0.1, "medium"), (0.3, "strong"), (None, "suspicious"))


def positive_probability(probability: Column | str, is_vector: bool = True) -> Column:
    """Probability of class 1 from an ML vector or an array column."""
    array = F.col(probability) if isinstance(probability, str) else probability
    return F.get(vector_to_array(array) if is_vector else array, F.lit(1))


def logit(probability: Column | str, clip: float = LOGIT_CLIP) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    p = F.greatest(F.least(p, F.lit(1 - clip)), F.lit(clip))
    return F.ln(p / (1 - p))


def bucket_of_rank(rank: str, total: str, buckets: int) -> Column:
    """The n-tile of a 1-based rank: the first ``total mod buckets`` tiles hold one more row."""
    size, longer = f"({total} div {buckets})", f"({total} % {buckets})"
    return F.expr(
        f"cast(case when {rank} <= {longer} * ({size} + 1) "
        f"then ({rank} - 1) div ({size} + 1) + 1 "
        f"else {longer} + ({rank} - {longer} * ({size} + 1) - 1) div greatest({size}, 1) + 1 end as int)"
    )


def band(value: Column | str, bands: tuple) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    *bounded, (_, last) = bands
    labels = F
    for upper, label in bounded:
        labels = labels.when(value < upper, label)
    return labels.otherwise(last)
