"""Demand analytics on Spark: a library of DataFrame -> DataFrame operators over a daily panel."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions travel to the executors with their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
