"""barloom: bar (OHLCV) time series on Spark.

Everything takes and returns DataFrames and composes with ``DataFrame.transform``.
"""

from barloom.spec import BarSpec

__all__ = ["BarSpec"]
