"""Operations of a training-data pipeline (decontamination, dedup, PII, ...)."""

import sys

from pyspark import cloudpickle

# Functions and models of this package travel to the executors by value, so
# they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
