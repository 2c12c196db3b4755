"""Operators of a training-data pipeline: filters, near duplicates, mixing and sharding of documents.

Functions of this package that run in Python tasks are sent by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
