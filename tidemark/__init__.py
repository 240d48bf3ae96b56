"""Monthly propensity work on Spark DataFrames: spine, cleaning, encoding,
feature ranking, boosted trees, scores, evaluation, drift audits."""

from tidemark.options import Options, SpineColumns

__all__ = ["Options", "SpineColumns"]
__version__ = "0.1.0"
