"""Operators for large text corpora. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
