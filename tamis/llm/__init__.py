"""Operators for large training-data pipelines; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors whole, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
