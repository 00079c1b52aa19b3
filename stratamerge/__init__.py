"""Spark-native integration of ragged attribute layers onto one geospatial base table."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
