"""cabinlens: passenger-survey preparation, profiling, modelling and scoring on Spark.

Functions take and return Spark DataFrames; fitted state is a small object
with ``transform``.  Python code that runs inside tasks (``mapInPandas``) is
shipped by value, so executors need no copy of this package installed.
"""

from pyspark import cloudpickle as _cloudpickle

import cabinlens as _self

_cloudpickle.register_pickle_by_value(_self)

__all__ = ["operators", "sources", "functions", "plans", "streaming"]
