"""Operators for large text corpora: scoring, rules, deduplication, mixing, packing, sharding and archives."""

import sys

from pyspark import cloudpickle

# The functions that run in Python workers travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
