"""Demand time series on Spark: event log to counts, forecasts, anomaly scores and metrics."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
