"""Operators for training data at scale. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions by value, so a cluster needs no copy of it on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
