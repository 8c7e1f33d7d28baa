"""Analytics of per-frame object detections on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, which then need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
