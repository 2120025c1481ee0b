"""Operators of a training-data pipeline over document tables."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
