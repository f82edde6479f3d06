"""Multi-source news and sentiment analytics as plain functions on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so that executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
