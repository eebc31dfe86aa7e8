"""Operators for preparing training data: packing, deduplication, filtering, archives, indexes."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel inside the tasks, so workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
