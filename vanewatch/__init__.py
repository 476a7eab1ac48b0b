"""Fleet telemetry analytics on Spark: remaining life, risk, alerts, drift and monitoring."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
