"""Spark-native table synchronisation through a message log."""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with them, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
