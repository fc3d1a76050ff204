"""raresight: rare-event (imbalanced classification) analytics on Spark DataFrames.

Every operator is a function ``DataFrame(s) -> DataFrame`` that is generic over
column names (label, score, feature list).  Nothing collects row data to the
driver; the few driver round trips fetch bounded summaries (a fitted
standardiser, quantile split points, a contract's failure counts).
"""

from raresight.session import checkpoint_dir, get_spark, scratch_path

__all__ = ["checkpoint_dir", "get_spark", "scratch_path"]
