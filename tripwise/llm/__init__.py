"""Operators of a training-data pipeline: tokens, packing, sharding, quality,
search, near-duplicates, toxicity, mixing and web archives.

Nothing else in the library imports this package.  Task functions are pickled
by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
