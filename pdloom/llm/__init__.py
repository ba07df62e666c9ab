"""Operators for preparing training text: duplicates, filters, formats, mixing and shards."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
