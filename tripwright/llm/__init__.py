"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
