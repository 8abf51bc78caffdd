"""Customer lifetime value on Spark DataFrames.

Raw order lines become cleaned daily orders, recency / frequency / monetary
features, hash splits, regression and repeat-purchase models, and serving
records.  Every step takes and returns a DataFrame.
"""

from custvalue.params import ClvParams

__all__ = ["ClvParams"]
