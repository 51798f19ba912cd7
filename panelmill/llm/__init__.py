"""Corpus operators for training-data pipelines.

Each module holds one operator with its own general interface; ``queries`` binds them to the given tables.
Functions that run in Python workers are pickled by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
