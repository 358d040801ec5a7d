"""Operators for training data: deduplication, search, packing, mixing, scoring and scanning.

Nothing else in the library imports this package. Its functions travel to the
executors by value, so the package needn't be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
